"""Column expressions: text analysis, identity, metadata."""
