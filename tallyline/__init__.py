"""Declarative reconciliation and data-quality checks over tabular sources, as plain DataFrame plans."""
