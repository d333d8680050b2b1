"""Column expressions: every function here maps columns to a column."""
