"""streaming of the catalog reconciliation engine."""
