"""Weather-feed analytics as Spark DataFrame, SQL and Structured Streaming operations."""
