"""Column functions: expressions only, no jobs."""
