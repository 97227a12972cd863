"""DataFrame-to-DataFrame operators: documents, search legs, fusion, look-ups, context."""
