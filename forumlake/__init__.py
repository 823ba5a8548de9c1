"""Forum item analytics as composable Spark DataFrame jobs."""
