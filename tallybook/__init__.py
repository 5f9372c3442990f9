"""Gaming-ledger analytics on Spark: plain functions from DataFrames to a DataFrame."""
