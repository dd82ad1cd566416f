"""Review data preparation as Spark DataFrame jobs."""
