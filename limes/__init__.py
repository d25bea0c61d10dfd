"""Administrative-boundary analytics expressed as Spark DataFrame operators."""
