"""Monthly stop-delay analytics as Spark DataFrame jobs."""
