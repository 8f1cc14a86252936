"""Reconciliation operators: rules, matching, comparison, rollup, completeness, reshaping, summaries."""
