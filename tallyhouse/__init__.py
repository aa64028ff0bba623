"""Transaction warehouse and data-quality toolkit on Spark DataFrames."""
