"""Column expressions of the warehouse jobs."""
