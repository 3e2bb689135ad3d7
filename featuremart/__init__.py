"""Monthly snapshot datamart, feature store and model monitoring on Spark DataFrames."""

__version__ = "0.1.0"
