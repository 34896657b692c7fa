"""lexatlas functions."""
