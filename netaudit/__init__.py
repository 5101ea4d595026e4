"""Network-log audit jobs on Spark DataFrames."""
