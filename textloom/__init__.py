"""Text and trend analytics expressed as Spark DataFrame jobs."""
