"""Column expressions. All of them are built-in Spark functions."""
