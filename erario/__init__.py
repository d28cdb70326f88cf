"""erario: a Spark-first engine for public-spending data."""
