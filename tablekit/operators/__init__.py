"""DataFrame operators: each takes tables and parameters and returns a table."""
