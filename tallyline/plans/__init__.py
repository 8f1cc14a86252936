"""Reconciliation plans of reports, and the query catalogue over the driver's tables."""
