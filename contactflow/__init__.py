"""Contact-validation analytics expressed as Spark DataFrame jobs."""
