"""Column expressions for fields of fixed-width records."""
