"""tabula: tabular machine learning and applied statistics on Spark DataFrames."""

__version__ = "0.1.0"
