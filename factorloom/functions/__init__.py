"""Column -> Column functions; all stay inside Spark's own expressions."""
