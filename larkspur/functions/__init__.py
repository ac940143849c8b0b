"""Column helpers built from Spark expressions, and custom pipeline stages."""
