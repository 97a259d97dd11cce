"""Feature engineering for weekly panels and collections of series, on Spark DataFrames."""

__version__ = "0.1.0"
