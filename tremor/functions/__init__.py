"""Column expressions: no function here triggers a job."""
