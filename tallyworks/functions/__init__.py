"""Column expressions. All are native Spark expressions, so Catalyst sees through them."""
