"""Column expressions: every function returns a Column and stays in codegen."""
