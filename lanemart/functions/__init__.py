"""Column expressions. Every one is a native Spark expression; there is no UDF in the package."""
