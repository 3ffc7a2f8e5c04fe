"""Road-traffic analytics as Spark DataFrame jobs."""
