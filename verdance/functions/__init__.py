"""Column expressions: scalar rules and geometry."""
