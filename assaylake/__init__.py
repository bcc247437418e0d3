"""assaylake - contract-driven medallion tables, data quality and PII protection on Spark."""

__version__ = "0.1.0"
