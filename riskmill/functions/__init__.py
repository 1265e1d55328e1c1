"""Column expressions shared by the operators. Each takes and returns a ``Column``."""
