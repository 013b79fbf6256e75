"""Star-schema retail analytics as Spark DataFrame transformations."""
