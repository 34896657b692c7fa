"""lexatlas: a PySpark-native engine that turns long documents into a queryable knowledge base."""
