"""Time-series features, forecast evaluation and drift checks as Spark DataFrame jobs."""
