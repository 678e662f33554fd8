"""martforge: flat files to a sales data mart, on Spark DataFrames."""

__version__ = "0.1.0"
