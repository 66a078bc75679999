"""Named queries (catalog) and their DuckDB oracle."""
