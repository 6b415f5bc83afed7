"""Column expressions and the MinHash function."""
