"""Job-market analytics as Spark DataFrame transformations."""
