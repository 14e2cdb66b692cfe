"""Order-book time series on Spark: every operator is DataFrame in, DataFrame out."""
