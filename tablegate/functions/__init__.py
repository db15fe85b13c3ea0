"""Column rules: kinds, widening, text decode and encode, units."""
