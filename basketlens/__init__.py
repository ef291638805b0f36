"""Household feature engineering for retail transactions, as composable Spark DataFrame operators."""

__version__ = "0.1.0"
