"""Column expressions: every function returns a native Spark column."""
