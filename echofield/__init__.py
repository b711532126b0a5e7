"""Review analytics expressed as Spark DataFrame jobs."""
