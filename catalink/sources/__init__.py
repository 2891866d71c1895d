"""sources of the catalog reconciliation engine."""
