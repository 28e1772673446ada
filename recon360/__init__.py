"""Customer-360 and order reconciliation on Spark DataFrames."""
