"""Column expressions: everything stays inside whole-stage code generation."""
