"""Panel forecasting on Spark: every function maps DataFrames or Columns to DataFrames or Columns."""
