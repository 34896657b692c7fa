"""lexatlas operators."""
