"""Column-level expressions, all built from ``pyspark.sql.functions``."""
