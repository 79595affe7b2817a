"""Trip cleaning and per-month rider summaries (BK1-BK8).

The source loops over 12 months x 2 rider types x 6 metrics on the driver; here
each metric family is one ``groupBy(rider, year, month)``.  Modes of several columns
share a single shuffle: the columns are stacked into ``(which, value)`` rows,
counted once, and the arg-max is taken per ``(key, which)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import hour_text, weekday_monday0

# Weekday names, Monday first (pandas ``dt.dayofweek`` order).
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

RAW_TRIP_COLUMNS = (
    "started_at",
    "ended_at",
    "member_casual",
    "rideable_type",
    "start_station_name",
    "end_station_name",
)


def clean_trips(raw: DataFrame) -> DataFrame:
    """Whole-row dedup, month/year of the start, ride length, weekday, and only
    rides with a non-negative length (NULL lengths drop too) (BK1).

    ``ride_length`` is kept as an interval and as whole seconds.
    """
    df = raw.dropDuplicates()
    df = df.withColumns(
        {
            "started_at": F.to_timestamp_ntz(F.col("started_at").cast("string"))
            if dict(df.dtypes)["started_at"] == "string"
            else F.col("started_at"),
            "ended_at": F.to_timestamp_ntz(F.col("ended_at").cast("string"))
            if dict(df.dtypes)["ended_at"] == "string"
            else F.col("ended_at"),
        }
    )
    df = df.withColumns(
        {
            "month": F.month("started_at"),
            "year": F.year("started_at"),
            "ride_length": F.col("ended_at") - F.col("started_at"),
            "ride_length_sec": F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at")),
            "day_of_week": weekday_monday0("started_at"),
        }
    )
    return df.filter(F.col("ride_length_sec") >= 0)


def day_label(c) -> F.Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), c.cast("int") + 1)


def modes(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value of each column in ``values`` per key, with its
    count; ties go to the smallest value (compared as strings) (A16, A17).

    Output: ``keys..., top_<v>, n_<v>`` for each ``v``.  One stacking projection, one
    counting aggregate (partial on the map side), one arg-max aggregate, one pivot
    on a handful of rows per key.
    """
    stacked = df.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(v).alias("which"), F.col(v).cast("string").alias("value")) for v in values])
        ).alias("_s"),
    ).select(*keys, "_s.which", "_s.value")
    counts = stacked.filter(F.col("value").isNotNull()).groupBy(*keys, "which", "value").agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = counts.groupBy(*keys, "which").agg(
        F.min_by(F.struct(F.col("value"), F.col("_n")), F.struct(-F.col("_n"), F.col("value"))).alias("_b")
    )
    wide = best.groupBy(*keys).pivot("which", list(values)).agg(F.first("_b"))
    out = [F.col(k) for k in keys]
    for v in values:
        out += [F.col(f"`{v}`.value").alias(f"top_{v}"), F.col(f"`{v}`.`_n`").alias(f"n_{v}")]
    return wide.select(*out)


def monthly_summary(trips: DataFrame, rider_col: str = "member_casual") -> DataFrame:
    """One row per rider type and month: favourite day, mean and total ride length,
    top start and end station, peak hour (``'HH:00'``) and rides in that hour,
    sorted by year and month (BK2-BK6)."""
    keys = [rider_col, "year", "month"]
    t = trips.withColumns(
        {"_day": day_label(F.col("day_of_week")), "_hour": hour_text("started_at")}
    )
    lengths = t.groupBy(*keys).agg(
        F.avg("ride_length_sec").alias("avg_ride_length_sec"),
        F.sum("ride_length_sec").alias("total_ride_length_sec"),
    )
    m = modes(t.withColumn("_dow", F.col("day_of_week")), keys, ["_dow", "start_station_name", "end_station_name", "_hour"])
    joined = lengths.join(m, keys, "left")
    return joined.select(
        "year",
        "month",
        F.col(rider_col).alias("membership"),
        day_label(F.col("top__dow")).alias("favourite_day"),
        "avg_ride_length_sec",
        "total_ride_length_sec",
        F.col("top_start_station_name").alias("top_start_station"),
        F.col("top_end_station_name").alias("top_end_station"),
        F.concat(F.col("top__hour"), F.lit(":00")).alias("peak_hour_time"),
        F.col("n__hour").alias("n_at_peak_hour"),
    ).orderBy("year", "month", "membership")
