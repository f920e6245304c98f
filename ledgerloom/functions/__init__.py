"""Column functions. Every one is a native Spark expression."""
