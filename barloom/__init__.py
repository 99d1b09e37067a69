"""Daily-market analytics on Spark: price bars, load decisions, listings, news."""

__version__ = "0.1.0"
