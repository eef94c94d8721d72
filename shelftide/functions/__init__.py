"""Column expressions: no DataFrame, no session."""
