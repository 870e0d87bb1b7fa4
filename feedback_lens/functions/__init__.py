"""Column functions; all run as native Spark expressions."""
