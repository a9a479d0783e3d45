"""Market analytics as Spark DataFrame operators."""
