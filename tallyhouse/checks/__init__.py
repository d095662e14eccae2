"""Independent SQL statements of the registered queries (DuckDB dialect)."""
