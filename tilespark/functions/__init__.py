"""Column functions: each takes and gives columns, and runs in generated code."""
