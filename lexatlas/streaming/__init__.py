"""lexatlas streaming."""
