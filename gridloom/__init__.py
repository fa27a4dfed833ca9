"""Power-system analytics expressed as Spark DataFrame operators."""
