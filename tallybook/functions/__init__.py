"""Column-level helpers: each takes and returns Columns, nothing else."""
