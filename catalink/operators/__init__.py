"""operators of the catalog reconciliation engine."""
