"""Table profiling and data-quality checks (A18-A24, A30, A31, F5, F8, F9, EC1).

A table profile is one aggregate pass over the table (all columns at once), then a
stack into long format on the single result row; quantiles and box statistics take
several aggregates each.  Nothing is looped on the driver.
Exact distinct counts are the default (the source's ``nunique``); pass
``approx=True`` for wide profiles of very large tables (HyperLogLog++, ~1% error).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerline.operators.joins import join_aggregate
from ledgerline.operators.order_stats import exact_quantiles, join_back, quantiles_of, value_counts_by


def numeric_columns(df: DataFrame) -> list[str]:
    """``select_dtypes(include='number')``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _stack(row_df: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One-row frame with ``<field>__<col>`` columns -> one row per column."""
    return row_df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{f}__{c}`").alias(f) for f in fields])
                    for c in cols
                ]
            )
        ).alias("_s")
    ).select("_s.*")


def profile_table(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: rows, non-null values, distinct values (NULL not counted), nulls."""
    cols = list(cols or df.columns)
    distinct = F.approx_count_distinct if approx else F.count_distinct
    aggs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        aggs += [
            F.count(F.col(c)).alias(f"n_non_null__{c}"),
            distinct(F.col(c)).alias(f"n_distinct__{c}"),
        ]
    one = df.agg(*aggs)
    out = _stack(one.withColumns({f"n_rows__{c}": F.col("_rows") for c in cols}), cols,
                 ["n_rows", "n_non_null", "n_distinct"])
    return out.withColumn("n_nulls", F.col("n_rows") - F.col("n_non_null"))


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row, whole row or on ``subset`` (``duplicated().sum()``,
    NULL compares equal to NULL) (A24).  One shuffle: group on the row, count > 1."""
    keys = list(subset or df.columns)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(
        F.sum("_n").alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
        F.count_if(F.col("_n") > 1).alias("n_repeated_keys"),
    )


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``describe()`` / ``groupby(k).describe()``: count, mean, sample std, min, linear
    25/50/75 % quantiles, max, per column (and per group) (A18, A19).

    All columns are stacked, so one keyed aggregate gives the moments of all of them and
    one chain of ``order_stats`` their quantiles; a column without values keeps its row.
    """
    keys = [*by, "column_name"]
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_x")) for c in cols]
    stacked = df.select(*by, F.explode(F.array(*cells)).alias("_s")).select(*by, "_s.*")
    x = F.col("_x")
    base = stacked.groupBy(*keys).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    if not by:  # an empty table has a row per column, too
        names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
        base = names.join(base, "column_name", "left").fillna(0, ["count"])
    q = exact_quantiles(stacked, "_x", keys, [0.25, 0.5, 0.75]).select(
        *keys, F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return join_aggregate(base, q, keys, "left").select(
        *by, "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def violation_rates(df: DataFrame, rules: dict[str, Column], places: int = 2) -> DataFrame:
    """Share (percent of all rows) breaking each rule, one pass.
    A rule that evaluates to NULL does not count as broken (as a pandas mask)."""
    from ledgerline.functions.columns import exact_pct

    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.coalesce(r, F.lit(False))).alias(name) for name, r in rules.items()]
    one = df.agg(*aggs)
    return one.select(
        *[F.col(n).alias(f"n_{n}") for n in rules],
        *[exact_pct(F.col(n), F.col("_n"), places).alias(f"pct_{n}") for n in rules],
    )


def negative_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: rows with a negative value and whether any exist."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        aggs += [F.count_if(F.col(c) < 0).alias(f"n_negative__{c}")]
    one = df.agg(*aggs)
    out = _stack(one, cols, ["n_negative"])
    return out.withColumn("has_negative", F.col("n_negative") > 0)


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Box-plot numbers per group: linear quartiles, 1.5 IQR whisker bounds, whisker
    ends (most extreme values inside the bounds) and the outlier count (A30).

    The rows are counted once per (group, value); quartiles, fences and outliers all
    come from these counts, whose exchange is reused.
    """
    values = value_counts_by(df, F.col(value), by)
    q = quantiles_of(values, by, [0.25, 0.5, 0.75]).select(
        *by, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumns(
        {
            "lower_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
            "upper_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
        }
    )
    numbers = ["n", "q1", "median", "q3", "lower_fence", "upper_fence"]
    inside = F.col("_v").between(F.col("lower_fence"), F.col("upper_fence"))
    return join_back(values, q, by).groupBy(*by, *numbers).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("_c")).otherwise(0)).alias("n_outliers"),
    )


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between min and max; the maximum goes in the last bin.
    One aggregate for the range, one for the counts."""
    x = F.col(value).cast("double")
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")).withColumn("_one", F.lit(1))
    j = df.select(x.alias("_x")).filter(F.col("_x").isNotNull()).withColumn("_one", F.lit(1)).join(
        F.broadcast(rng), "_one"
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width).cast("int") + 1, F.lit(bins))
    )
    g = j.groupBy(b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    return g.select(
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"),
        (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_end"),
        "count",
    )
