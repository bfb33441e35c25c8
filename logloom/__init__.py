"""Log analytics as Spark DataFrame transformations."""
