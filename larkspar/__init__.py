"""Analytics operators written as plain PySpark: DataFrames in, DataFrames out."""
