"""Column expressions; all of them compile to built-in Spark functions."""
