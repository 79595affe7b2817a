"""ledgerline: table-level analytics operators written as Spark DataFrame, SQL and ML jobs.

Sub-packages
------------
sources    -- table loaders and sinks (parquet, CSV sets, written tables)
functions  -- Column-level helpers (calendar, codes, bins, exact rounding, distributions)
operators  -- composite operators (before/after impact, share of total, funnels,
              visit summaries, trip summaries, profiling, statistics, modelling)
plans      -- reference-shaped inputs derived from the test tables, and the query catalog
streaming  -- the stateless event operators applied to a streaming DataFrame
"""

__version__ = "0.1.0"
