"""Time-stamped observation tables on Spark DataFrames."""
