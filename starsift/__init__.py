"""Review analytics as Spark DataFrame operators."""
