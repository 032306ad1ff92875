"""Consumer-lending risk analytics as plain Spark DataFrame transformations."""
