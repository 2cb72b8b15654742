"""lagframe: lagged weekly time-series analytics for many places at once, on Spark.

Subpackages:
  functions  -- native column expressions (week calendars, p-values, scaling, accents)
  operators  -- DataFrame operators (roll-up, lag join, correlation sweep, screening, forecast)
  sources    -- landed CSV / JSON ingest, table appends, de-duplication, CSV sinks
  plans      -- test-data views, registered queries and their DuckDB oracles
  streaming  -- incremental ingest of landed files
"""

__version__ = "0.1.0"
