"""Join helpers.

Joins carry no hint: tables are broadcast by Catalyst's and AQE's byte statistics, beyond
them the join is sort-merge or shuffled hash with AQE's skew split.  Only lookup tables that
are written out in code, whose size is fixed, are marked for broadcast where they are made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join_aggregate(df: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a per-group aggregate (ranges, offsets, class sizes: one row per group or
    per group and bucket) back to its rows.  A NULL key is a group like any other.

    No explicit broadcast and no size-probing job: that probe would aggregate the whole
    input once more.  With AQE the aggregate's shuffle stage is measured when it
    finishes and the join becomes a broadcast hash join if it is small, else it stays
    a shuffle join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    side = small.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(side, reduce(lambda a, b: a & b, same), how).drop(*[f"_key_{k}" for k in keys])
