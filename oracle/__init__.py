"""SQL twins of the registered queries, written independently for DuckDB."""
