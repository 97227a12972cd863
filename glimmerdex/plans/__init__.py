"""Plan helpers (size checks, top-k) and the registered queries with their check SQL."""
