"""Named queries (queries) and their DuckDB counterparts (oracles)."""
