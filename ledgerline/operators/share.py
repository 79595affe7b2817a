"""Shares, frequency tables, modes and top-k.

Grand totals are joined back as a one-row broadcast on a constant key rather than
an un-partitioned window, so the grouped rows never collapse into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import exact_ratio
from ledgerline.operators.joins import join_aggregate


def with_total(grouped: DataFrame, measure: str, within: Sequence[str] = (), name: str = "_total") -> DataFrame:
    """Attach ``sum(measure)`` over ``within`` (or over everything) to each grouped row.

    ``within`` empty: the one-row total is broadcast on a constant key (its size is
    one row by construction).  Otherwise the totals per ``within`` key are joined back
    on that key; both sides are already reduced to one row per group.
    """
    if not within:
        total = grouped.agg(F.sum(measure).alias(name)).withColumn("_one", F.lit(1))
        return grouped.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").drop("_one")
    totals = grouped.groupBy(*within).agg(F.sum(measure).alias(name))
    return join_aggregate(grouped, totals, list(within), "left")


def share_of_total(
    df: DataFrame,
    by: Sequence[str],
    within: Sequence[str] = (),
    measure: str = "sales",
    round_to: int = 2,
    as_percent: bool = True,
    name: str = "share",
    scale: int = 2,
) -> DataFrame:
    """``round(sum(x by) / sum(x within), k) * 100`` on exact decimals (DM7-DM9, A27, A28).

    The source wrote this as row-level windows re-aggregated; since every row of a
    group carries the same two totals, that equals the ratio of the two sums.
    """
    g = df.groupBy(*by).agg(F.sum(measure).alias("_part"))
    g = with_total(g, "_part", within)
    ratio = F.round(exact_ratio(F.col("_part"), F.col("_total"), scale), round_to)
    if as_percent:
        ratio = ratio * 100
    return g.withColumn(name, ratio.cast("double"))


def ratio_of_sums(num: str, den: str, places: int = 2, num_scale: int = 2) -> Column:
    """``round(sum(a) / sum(b), k)`` (A9).  ``b`` is an integer count, ``a`` a decimal."""
    a = F.sum(num)
    b = F.sum(den).cast("decimal(20,0)")
    units_per_row = F.when(b != 0, (a * F.lit(10**num_scale)).cast("decimal(20,0)") / b)
    return F.round(units_per_row, places - num_scale) / F.lit(10**num_scale)


def value_counts(df: DataFrame, cols: str | Sequence[str], name: str = "count") -> DataFrame:
    """Frequency table without NULLs, most frequent first."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return (
        df.filter(cond)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), *[F.col(c).asc() for c in cols])
    )


def percent_distribution(df: DataFrame, c: str, places: int | None = None) -> DataFrame:
    """``value_counts(normalize=True) * 100`` over non-NULL values."""
    g = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    g = with_total(g, "n")
    pct = F.col("n").cast("double") * 100.0 / F.col("_total").cast("double")
    return g.select(c, F.col("n").alias("count"), pct.alias("percent")).orderBy(c)


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence, total: str = "total") -> DataFrame:
    """Count table ``row x col`` with zero fill and a row total.

    The pivot values are given, so Spark does not run an extra job to find them.
    """
    p = df.groupBy(row).pivot(col, list(values)).count().na.fill(0)
    names = [str(v) for v in values]
    tot = sum((F.col(f"`{n}`") for n in names), F.lit(0))
    return p.withColumn(total, tot)
