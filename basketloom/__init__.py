"""Customer and retail analytics as Spark DataFrame operators."""
