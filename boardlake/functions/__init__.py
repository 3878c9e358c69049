"""Column-expression builders (all built-in Spark SQL functions, no UDFs)."""
