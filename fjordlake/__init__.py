"""Labour-market data operators on Spark: DataFrames in, DataFrames out."""
