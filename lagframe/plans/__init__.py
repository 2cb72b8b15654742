"""lagframe.plans: test-data views, registered queries and their DuckDB oracles."""
