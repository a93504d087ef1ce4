"""Credit-risk analytics as Spark DataFrame operators."""
