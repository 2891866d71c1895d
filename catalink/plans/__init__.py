"""plans of the catalog reconciliation engine."""
