"""sluice: corpus preparation written as Spark DataFrame and Column functions."""

__version__ = "0.1.0"
