"""Column expressions and ordered computations shared by the operators."""
