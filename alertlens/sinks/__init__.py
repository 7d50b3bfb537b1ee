"""Writers (K1-K7)."""
