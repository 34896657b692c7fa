"""lexatlas sources."""
