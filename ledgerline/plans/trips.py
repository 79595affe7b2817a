"""Trip queries (BK1-BK8) over the stand-in trips table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import hour_text
from ledgerline.operators.share import value_counts
from ledgerline.operators.trips import clean_trips, day_label, modes, monthly_summary
from ledgerline.plans.standins import raw_trips

KEYS = ["member_casual", "year", "month"]


def _trips(spark, d):
    return clean_trips(raw_trips(spark, d))


def bk1_clean_trips(spark: SparkSession, d: str) -> DataFrame:
    return _trips(spark, d).drop("ride_length")


def bk2_favourite_day(spark: SparkSession, d: str) -> DataFrame:
    m = modes(_trips(spark, d), KEYS, ["day_of_week"])
    return m.select(*KEYS, day_label(F.col("top_day_of_week")).alias("favourite_day"),
                    F.col("n_day_of_week").alias("n_rides"))


def bk3_ride_length(spark: SparkSession, d: str) -> DataFrame:
    return _trips(spark, d).groupBy(*KEYS).agg(
        F.avg("ride_length_sec").alias("avg_ride_length_sec"),
        F.sum("ride_length_sec").alias("total_ride_length_sec"),
    )


def bk4_top_stations(spark: SparkSession, d: str) -> DataFrame:
    return modes(_trips(spark, d), KEYS, ["start_station_name", "end_station_name"])


def bk5_peak_hour(spark: SparkSession, d: str) -> DataFrame:
    t = _trips(spark, d).withColumn("time_stamp_hour", hour_text("started_at"))
    return modes(t, KEYS, ["time_stamp_hour"])


def bk6_monthly_summary(spark: SparkSession, d: str) -> DataFrame:
    return monthly_summary(_trips(spark, d))


def bk7_ride_types(spark: SparkSession, d: str) -> DataFrame:
    return value_counts(_trips(spark, d), ["member_casual", "rideable_type"])


def bk8_rides_per_hour(spark: SparkSession, d: str) -> DataFrame:
    t = _trips(spark, d).withColumn("time_stamp_hour", hour_text("started_at"))
    return value_counts(t, ["member_casual", "time_stamp_hour"]).orderBy("member_casual", "time_stamp_hour")


QUERIES = {
    "bk1_clean_trips": bk1_clean_trips,
    "bk2_favourite_day": bk2_favourite_day,
    "bk3_ride_length": bk3_ride_length,
    "bk4_top_stations": bk4_top_stations,
    "bk5_peak_hour": bk5_peak_hour,
    "bk6_monthly_summary": bk6_monthly_summary,
    "bk7_ride_types": bk7_ride_types,
    "bk8_rides_per_hour": bk8_rides_per_hour,
}
