"""Monthly time-series features, training and scoring as Spark DataFrame jobs."""
