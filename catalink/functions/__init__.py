"""functions of the catalog reconciliation engine."""
