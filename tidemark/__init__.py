"""tidemark: data quality, cleaning and inference over tables of any size, on Spark DataFrames."""

__version__ = "0.1.0"
