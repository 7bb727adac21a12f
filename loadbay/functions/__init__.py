"""Column factories shared by the operators; all are built-in Spark expressions."""
