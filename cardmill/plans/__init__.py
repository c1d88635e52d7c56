"""Jobs: read tables, apply operators, write tables."""
