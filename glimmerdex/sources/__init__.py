"""Where documents come from and where the index is kept."""
