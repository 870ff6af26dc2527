"""Hospital census, billing and emergency reports as Spark DataFrame jobs."""
