"""Urban-mobility analytics as Spark DataFrame jobs."""
