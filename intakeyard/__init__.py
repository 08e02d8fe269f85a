"""Intake-quality engine on Spark: validate, profile, compare, ledger, publish, inventory."""

__version__ = "0.1.0"
