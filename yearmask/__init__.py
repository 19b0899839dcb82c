"""Host-year evidence analytics as Spark DataFrame jobs."""
