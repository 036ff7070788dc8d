"""Column expressions and geometry helpers shared by the operators."""
