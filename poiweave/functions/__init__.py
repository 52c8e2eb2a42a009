"""Column expressions used by the jobs.  Built-in functions only, no Python UDF."""
