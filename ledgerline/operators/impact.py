"""Before/after impact analysis (DM3, DM11-DM19, A35).

The source computes each comparison as ``group by period`` followed by
``lag(sum(x)) over (partition by k order by period desc)`` and keeps the row whose
lag is set.  With exactly two periods that is the same as one conditional
aggregation per key -- one shuffle on the key, no sort, no window:

    after_total  = sum(x) filter (period = after)
    before_total = sum(x) filter (period = before)
    kept only where both periods have rows

Partial aggregation happens map-side, so even a key holding a third of all rows
only sends one partial row per task and key through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import exact_ratio

BEFORE, AFTER = "before", "after"


def label_periods(
    period: str | Column, before: tuple[int, int], after: tuple[int, int]
) -> Column:
    """``'before'`` / ``'after'`` for closed ranges of a period number, else NULL."""
    p = F.col(period) if isinstance(period, str) else period
    return (
        F.when(p.between(*before), F.lit(BEFORE))
        .when(p.between(*after), F.lit(AFTER))
    )


def before_after(
    df: DataFrame,
    by: Sequence[str],
    period_col: str,
    before: tuple[int, int],
    after: tuple[int, int],
    measure: str = "sales",
) -> DataFrame:
    """One row per key with ``before_total``, ``after_total`` and row counts.

    Rows outside both windows are filtered before the shuffle (the filter reaches the
    scan when ``period_col`` is a stored column).
    """
    lo, hi = min(before[0], after[0]), max(before[1], after[1])
    p = label_periods(period_col, before, after)
    x = F.col(measure)
    return (
        df.filter(F.col(period_col).between(lo, hi))
        .withColumn("_period", p)
        .groupBy(*by)
        .agg(
            F.sum(F.when(F.col("_period") == AFTER, x)).alias("after_total"),
            F.sum(F.when(F.col("_period") == BEFORE, x)).alias("before_total"),
            F.count_if(F.col("_period") == AFTER).alias("n_after"),
            F.count_if(F.col("_period") == BEFORE).alias("n_before"),
        )
    )


def pct_change(after: Column, before: Column, style: str) -> Column:
    """Percent change with the rounding of the source, on exact decimals.

    ``r3x100``   round(after/before - 1, 3) * 100            (DM15-DM17)
    ``r4x100``   round(round((after-before)/before, 4) * 100, 2)  (DM13, DM14, DM18, DM19)
    ``x100r2``   round(nullif(after/before - 1, 0) * 100, 2)  (DM11, DM12)
    """
    ratio = exact_ratio(after - before, before)
    if style == "r3x100":
        out = F.round(ratio, 3) * 100
    elif style == "r4x100":
        out = F.round(F.round(ratio, 4) * 100, 2)
    elif style == "x100r2":
        out = F.round(F.nullif(ratio, F.lit(0)) * 100, 2)
    else:
        raise ValueError(style)
    return out.cast("double")


def impact_by(
    df: DataFrame,
    dim: str,
    period_col: str = "week_number",
    before: tuple[int, int] = (13, 24),
    after: tuple[int, int] = (25, 36),
    measure: str = "sales",
    style: str = "r3x100",
) -> DataFrame:
    """Impact of the change per value of one dimension (DM15-DM19), worst first."""
    ba = before_after(df, [dim], period_col, before, after, measure)
    return (
        ba.filter((F.col("n_after") > 0) & (F.col("n_before") > 0))
        .select(
            F.col(dim),
            F.col("after_total").cast("double").alias("total_sales"),
            F.col("before_total").cast("double").alias("prev_tot_sales"),
            (F.col("after_total") - F.col("before_total")).cast("double").alias("diff_sales"),
            pct_change(F.col("after_total"), F.col("before_total"), style).alias("perc_diff_sales"),
        )
        .orderBy(F.col("perc_diff_sales").asc_nulls_last(), F.col(dim).asc_nulls_last())
    )


def impact_all_dims(
    df: DataFrame,
    dims: Sequence[str],
    period_col: str = "week_number",
    before: tuple[int, int] = (13, 24),
    after: tuple[int, int] = (25, 36),
    measure: str = "sales",
    style: str = "r3x100",
) -> DataFrame:
    """All dimensions in one scan with GROUPING SETS (A35): long format
    ``(dimension, value, total_sales, prev_tot_sales, diff_sales, perc_diff_sales)``."""
    lo, hi = min(before[0], after[0]), max(before[1], after[1])
    x = F.col(measure)
    base = df.filter(F.col(period_col).between(lo, hi)).withColumn(
        "_period", label_periods(period_col, before, after)
    )
    base = base.select(*[F.col(d).cast("string").alias(d) for d in dims], "_period", x.alias("_x"))
    is_after, is_before = F.col("_period") == "after", F.col("_period") == "before"
    agg = base.groupingSets([[d] for d in dims], *dims).agg(
        *[F.grouping(d).alias(f"_g_{d}") for d in dims],
        F.sum(F.when(is_after, F.col("_x"))).alias("after_total"),
        F.sum(F.when(is_before, F.col("_x"))).alias("before_total"),
        F.count_if(is_after).alias("n_after"),
        F.count_if(is_before).alias("n_before"),
    )
    kept = {d: F.col(f"_g_{d}") == 0 for d in dims}
    agg = agg.withColumns({
        "dimension": F.coalesce(*[F.when(k, F.lit(d)) for d, k in kept.items()]),
        "value": F.coalesce(*[F.when(k, F.col(d)) for d, k in kept.items()]),
    })
    return agg.filter((F.col("n_after") > 0) & (F.col("n_before") > 0)).select(
        "dimension",
        "value",
        F.col("after_total").cast("double").alias("total_sales"),
        F.col("before_total").cast("double").alias("prev_tot_sales"),
        (F.col("after_total") - F.col("before_total")).cast("double").alias("diff_sales"),
        pct_change(F.col("after_total"), F.col("before_total"), style).alias("perc_diff_sales"),
    )


def impact_by_year(
    df: DataFrame,
    years: Sequence[int],
    period_col: str = "week_number",
    before: tuple[int, int] = (21, 24),
    after: tuple[int, int] = (25, 28),
    measure: str = "sales",
    year_col: str = "calendar_year",
) -> DataFrame:
    """Same windows compared across years (DM13, DM14); rows with no change drop,
    as ``sales_diff != 0`` does (a year missing one period has a NULL diff)."""
    ba = before_after(df.filter(F.col(year_col).isin(list(years))), [year_col], period_col, before, after, measure)
    diff = F.col("after_total") - F.col("before_total")
    return (
        ba.filter((F.col("n_after") > 0) & (F.col("n_before") > 0) & (diff != 0))
        .select(
            F.col(year_col),
            diff.cast("double").alias("sales_diff"),
            F.col("before_total").cast("double").alias("prev_total_sales"),
            pct_change(F.col("after_total"), F.col("before_total"), "r4x100").alias("perc_sales_change"),
        )
        .orderBy(year_col)
    )


def period_totals(
    df: DataFrame,
    period_col: str = "week_number",
    before: tuple[int, int] = (21, 24),
    after: tuple[int, int] = (25, 28),
    measure: str = "sales",
) -> DataFrame:
    """Two rows, ``before`` then ``after``, with the previous total and the change (DM11, DM12).

    The lag runs over the two aggregated rows only (W3); the source's unordered
    ``lag() over ()`` is taken as that same order.
    """
    lo, hi = min(before[0], after[0]), max(before[1], after[1])
    grouped = (
        df.filter(F.col(period_col).between(lo, hi))
        .withColumn("time_period", label_periods(period_col, before, after))
        .filter(F.col("time_period").isNotNull())  # periods between the two windows
        .groupBy("time_period")
        .agg(F.sum(measure).alias("_total"))
    )
    w = W.orderBy(F.col("time_period").desc())
    prev = F.lag("_total").over(w)
    return (
        grouped.withColumn("_prev", prev)
        .select(
            "time_period",
            F.col("_total").cast("double").alias("total_sales"),
            F.col("_prev").cast("double").alias("prev_total_sales"),
            (F.col("_total") - F.col("_prev")).cast("double").alias("sales_diff"),
            pct_change(F.col("_total"), F.col("_prev"), "x100r2").alias("rate_before_after"),
        )
        .orderBy(F.col("time_period").desc())
    )


def missing_periods(df: DataFrame, period_col: str, lo: int = 1, hi: int = 52) -> DataFrame:
    """Period numbers in ``[lo, hi]`` that never occur (DM3).

    The data side is first reduced to its distinct period numbers (at most ``hi``
    values after map-side aggregation), then a left-anti join against ``range``.
    """
    spark = df.sparkSession
    present = df.select(F.col(period_col).cast("bigint").alias(period_col)).distinct()
    every = spark.range(lo, hi + 1).withColumnRenamed("id", period_col)
    return every.join(present, period_col, "left_anti").orderBy(period_col)
