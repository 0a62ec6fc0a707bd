"""Column functions; all are built from Spark's own expressions."""
