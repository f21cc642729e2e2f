"""Review mining on Spark: DataFrame-in, DataFrame-out operators for review tables and stored pages."""
