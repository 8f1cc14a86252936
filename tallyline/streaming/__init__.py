"""Reconciliation of files as they arrive."""
