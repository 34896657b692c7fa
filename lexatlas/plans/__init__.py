"""lexatlas plans."""
