"""Taxpayer-network risk analytics expressed as Spark DataFrame jobs.

Sub-packages:
  sources    -- reading inputs (parquet, catalog, csv), the TESTDATA bindings, sinks
  functions  -- column-expression helpers (safe division, clamps, periods, money)
  operators  -- the analytical operators, one module per family
  plans      -- loop helper (checkpointed iteration) and composed jobs
  sql        -- DuckDB SQL twins of every operator, used as the correctness oracle
"""

__version__ = "0.1.0"
