"""Order statistics by range partitioning at sampled pivots.

Values are counted once per (group, distinct value), then cut into ranges whose
borders are quantiles of the group's own distinct values, not equal steps between
its extremes: a far outlier takes a place, not a range.  Per range only a count
leaves the task; prefix sums over these counts give the rank at which a range
begins, and only ranges that hold a wanted rank are sorted.

The pivots come from ``percentile_approx`` with ``ACCURACY``: its sketch is merged
map-side and has a bounded size per group, and a range holds at most
``1 / RANGES + 2 / ACCURACY`` of a group's distinct values, under twice its share.
Groups of up to ``RANGES`` distinct values are one range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.operators.joins import join_aggregate

RANGES, ACCURACY = 256, 1024


def value_counts_by(df: DataFrame, value: Column, by: Sequence[str]) -> DataFrame:
    """``by..., _v, _c``: how often each value occurs in its group; NULL values do not count, NULL groups do."""
    vals = df.select(*by, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    return vals.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))


def with_range(per: DataFrame, by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Distinct values ``per(by..., _v)`` with ``_b``: how many of the group's pivots lie below the value.

    The pivots are found by halving: a fold of fixed length over the step sizes, no loop over the pivots.
    """
    ranges = ranges or RANGES
    shares = F.array(*[F.lit((i + 1) / ranges) for i in range(ranges - 1)])
    pivots = per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_m"), F.percentile_approx("_v", shares, F.lit(ACCURACY)).alias("_pivots")
    )
    pivots = pivots.select(*by, F.when(F.col("_m") > ranges, F.col("_pivots")).alias("_pivots"))
    steps = F.array(*[F.lit(1 << i) for i in range((ranges - 1).bit_length() - 1, -1, -1)])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get("_pivots", at + step - 1) < F.col("_v"), at + step).otherwise(at)
    )
    return join_back(per, pivots, by).withColumn("_b", F.coalesce(found, F.lit(0))).drop("_pivots")


def join_back(df: DataFrame, per_group: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """``join_aggregate`` that also serves the one group of an empty ``by`` (one row on the other side)."""
    if by:
        return join_aggregate(df, per_group, list(by), how)
    one = F.broadcast(per_group.withColumn("_one", F.lit(1)))
    return df.withColumn("_one", F.lit(1)).join(one, "_one", how).drop("_one")


def range_offsets(ranged: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``by..., _b`` and for each of ``sums`` its total in the range (``<c>_in``) and in the ranges before (``<c>_before``)."""
    keys = list(by) or [F.lit(1)]
    before = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_b").agg(*[F.sum(c).alias(f"{c}_in") for c in sums])
    return totals.select(
        "*", *[F.coalesce(F.sum(f"{c}_in").over(before), F.lit(0)).alias(f"{c}_before") for c in sums]
    )


def values_at_ranks(per: DataFrame, by: Sequence[str], wanted: Column) -> DataFrame:
    """``by..., n, _ranks``: a map from each 0-based rank in ``wanted`` (an array over the group's row count ``n``)
    to the value that holds it when the group's rows are sorted.

    Only the ranges that hold a wanted rank are sorted, each in a window of its own.
    """
    ranged = with_range(per, by)
    offsets = range_offsets(ranged, by, ["_c"])
    sizes = offsets.groupBy(*by).agg(F.sum("_c_in").alias("n"))
    held = join_back(offsets, sizes, by).select("*", F.explode(F.array_distinct(wanted)).alias("_rank"))
    held = held.filter((F.col("_c_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_c_before") + F.col("_c_in")))
    held = held.groupBy(*by, "_b", "_c_before", "n").agg(F.collect_set("_rank").alias("_wanted"))
    rows = join_aggregate(ranged, held, [*by, "_b"])
    inside = W.partitionBy(*by, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    first = F.col("_c_before") + F.coalesce(F.sum("_c").over(inside), F.lit(0))
    rows = rows.withColumn("_first", first).withColumn("_rank", F.explode("_wanted"))
    rows = rows.filter((F.col("_first") <= F.col("_rank")) & (F.col("_rank") < F.col("_first") + F.col("_c")))
    return rows.groupBy(*by).agg(
        F.any_value("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_ranks")
    )


def quantiles_of(per: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles (pandas / ``quantile_cont``) of counted values ``per(by..., _v, _c)``:
    ``by..., n, q0, q1, ...``, one column per probability."""
    places = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ends = [f(h).cast("long") for h in places for f in (F.floor, F.ceil)]
    g = values_at_ranks(per, by, F.array(*ends))
    out = []
    for i, h in enumerate(places):
        low, high = (F.element_at("_ranks", f(h).cast("long")) for f in (F.floor, F.ceil))
        out.append((low + (h - F.floor(h)) * (high - low)).alias(f"q{i}"))
    return g.select(*by, "n", *out)


def exact_quantiles(df: DataFrame, value: str, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles of a column per group: ``by..., n, q0, q1, ...``; exact, no group in one task."""
    return quantiles_of(value_counts_by(df, F.col(value), by), by, probs)


def cumulated(per: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``per(by..., _v, sums...)`` with, for each of ``sums``, the total over smaller values (``<c>_below``) and over
    the group (``<c>_all``); a range is one window, ranges before it are prefix sums."""
    ranged = with_range(per, by)
    offsets = range_offsets(ranged, by, sums)
    whole = offsets.groupBy(*by).agg(*[F.sum(f"{c}_in").alias(f"{c}_all") for c in sums])
    rows = join_back(join_aggregate(ranged, offsets, [*by, "_b"]), whole, by)
    inside = W.partitionBy(*by, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    below = [(F.col(f"{c}_before") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_below") for c in sums]
    return reduce(lambda d, c: d.drop(f"{c}_in", f"{c}_before"), sums, rows.select("*", *below)).drop("_b")
