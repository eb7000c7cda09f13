"""Reading and writing tables, and the customer mart built from the given tables."""
