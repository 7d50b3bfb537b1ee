"""Column -> Column helpers: constants, calendar (C1-C4) and scalars."""
