"""Column expressions and other building blocks shared by the operators."""
