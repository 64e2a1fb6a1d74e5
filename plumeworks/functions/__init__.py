"""Column expressions: every function here maps columns to a column and stays in codegen."""
