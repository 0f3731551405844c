"""DataFrame operators: pure functions from tables to tables."""
