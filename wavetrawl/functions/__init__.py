"""Column expressions. All are native Spark expressions; none runs Python per row."""
