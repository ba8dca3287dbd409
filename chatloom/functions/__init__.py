"""Column functions: every one returns a Catalyst expression, none is a Python UDF."""
