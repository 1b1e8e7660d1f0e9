"""Column-level functions built from native Spark expressions."""
