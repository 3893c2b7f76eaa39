"""Payment analytics as Spark DataFrame, SQL, Structured Streaming and ML jobs."""
