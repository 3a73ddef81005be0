"""Column expressions and DataFrame building blocks shared by the jobs."""
