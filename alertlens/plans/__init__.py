"""Composite outputs (R1-R6) and the weekly run."""
