"""Registry history and data quality as Spark DataFrame jobs."""
