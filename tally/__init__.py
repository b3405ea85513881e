"""tally: ledger export, audit, imputation, size-bounded splitting and verification on Spark."""

__version__ = "0.1.0"
