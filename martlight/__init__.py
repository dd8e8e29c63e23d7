"""Marketing-analytics marts, metrics and checks as PySpark DataFrame jobs."""
