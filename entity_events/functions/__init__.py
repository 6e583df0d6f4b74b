"""Column -> Column functions."""
