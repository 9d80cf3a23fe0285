"""Column functions (all built-in Spark expressions) and small driver-side helpers."""
