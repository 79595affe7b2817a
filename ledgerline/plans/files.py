"""Queries over written files and tables: CSV sets with malformed lines (S1-S3, U1, P6, P18, X13),
CSV summaries (S9) and a refreshed, partitioned table (S5).

The files are written from the given tables: a trip per line item, one folder a month.  Of every 50
orders three have malformed lines: one field short, a word for a number, one field too many.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import to_numeric
from ledgerline.operators.stats import standardize
from ledgerline.operators.profile import negative_columns
from ledgerline.operators.trips import clean_trips
from ledgerline.plans.claims import NUMERIC
from ledgerline.plans.standins import RIDER_BY_LINESTATUS, _case, claims, clean_sales
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.store import refresh
from ledgerline.sources.tables import load_table, read_csv_set, read_csv_with_rejects, rejects_by_file, write_csv

TRIP_SCHEMA = "ride_id string, started_at string, ended_at string, minutes int, member_casual string, station string"
SHORT, WORD, LONG = 7, 13, 21


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written_trips(spark: SparkSession, d: str) -> DataFrame:
    """The trips' lines written as text by month and read back with ``TRIP_SCHEMA``, rejected lines marked."""
    li, o = load_table(spark, d, "lineitem"), load_table(spark, d, "orders")
    j = li.join(o.select("o_orderkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
    start = F.timestamp_add("HOUR", F.col("l_quantity").cast("int") % 24, F.col("o_orderdate"))
    kind = F.col("l_orderkey") % 50
    fields = [
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        F.date_format(start, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd HH:mm:ss"),
        F.when(kind == WORD, F.lit("soon")).otherwise(F.col("l_quantity").cast("int").cast("string")),
        _case("l_linestatus", RIDER_BY_LINESTATUS),
        F.concat(F.lit("Station "), F.col("l_suppkey").cast("string")),
    ]
    line = F.when(kind == SHORT, F.concat_ws(",", *fields[:-1])).when(kind == LONG, F.concat_ws(",", *fields, F.lit("x"))).otherwise(F.concat_ws(",", *fields))
    path = _folder(spark, "trip-lines")
    j.select(line.alias("value"), F.date_format("o_orderdate", "yyyy-MM").alias("file_month")).write.partitionBy("file_month").text(path)
    return read_csv_with_rejects(spark, path, f"{TRIP_SCHEMA}, file_month string", header=False)


def s1_trips_from_csv(spark: SparkSession, d: str) -> DataFrame:
    """Trips read from the monthly files, times parsed from text, cleaned and summed up (BK1 on files)."""
    good = _written_trips(spark, d).filter("_rejected is null").drop("_rejected", "source_file")
    t = clean_trips(good)
    return t.groupBy("file_month", "member_casual").agg(
        F.count(F.lit(1)).alias("n_rides"), F.sum("ride_length_sec").alias("total_sec"), F.sum("minutes").alias("minutes")
    )


def s3_rejects_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Lines, rejected lines and kept lines of each month's files: none is lost silently."""
    return rejects_by_file(_written_trips(spark, d), "file_month")


def s3_rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    """What kinds of lines were rejected, by their number of fields."""
    bad = _written_trips(spark, d).filter("_rejected is not null")
    return bad.groupBy(F.size(F.split("_rejected", ",")).alias("n_fields")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("_rejected").contains("soon")).alias("n_words"))


def p18_station_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Text split into columns: the station's name and number, the day and the hour of the start."""
    good = _written_trips(spark, d).filter("_rejected is null")
    day, clock = F.split("started_at", " ")[0], F.split("started_at", " ")[1]
    split = good.select(
        F.split("station", " ")[0].alias("station_word"), to_numeric(F.split("station", " ")[1], coerce=True, to="int").alias("number"),
        to_numeric(F.split("station", " ")[0], coerce=True).alias("no_number"), day.alias("day"), F.substring(clock, 1, 2).cast("int").alias("hour"))
    return split.groupBy("station_word", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("number").alias("sum_numbers"), F.count("no_number").alias("n_no_number"),
        F.count_distinct("day").alias("n_days"))


def s9_summary_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Order totals by month and status, written as one header CSV file and read back strictly."""
    o = load_table(spark, d, "orders")
    g = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(20,2)").alias("total"))
    path = _folder(spark, "order-summary")
    write_csv(g, path, single_file=True)
    back = read_csv_set(spark, path, "month string, status string, n_orders long, total decimal(20,2)", source_col=None)
    return back.withColumn("total", F.col("total").cast("double"))


def s5_refreshed_sales_by_region(spark: SparkSession, d: str) -> DataFrame:
    """The clean sales table written anew, partitioned by year, and one year of it read back."""
    table = refresh(spark, "refreshed_sales", d, lambda: clean_sales(spark, d), ["calendar_year"])
    return table.filter(F.col("calendar_year") == 2000).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("transactions").alias("transactions"), F.sum("sales").cast("double").alias("sales"))


def p20_scaled_claims(spark: SparkSession, d: str) -> DataFrame:
    """``scale()`` of the claims' numbers, to six places."""
    c = standardize(claims(spark, d).select("claim_order", "claim_line", *NUMERIC), NUMERIC)
    return c.select("claim_order", "claim_line", *[(F.round(v, 6) + 0.0).alias(v) for v in NUMERIC])


def p22_negative_numeric_columns(spark: SparkSession, d: str) -> DataFrame:
    """Negative values in all numeric columns of the line items, found by type."""
    return negative_columns(load_table(spark, d, "lineitem").withColumn("net_of_discount", F.col("l_extendedprice") * (F.col("l_discount") - F.lit(0.05))))


QUERIES = {
    "s1_trips_from_csv": s1_trips_from_csv,
    "s3_rejects_by_file": s3_rejects_by_file,
    "s3_rejected_lines": s3_rejected_lines,
    "p18_station_numbers": p18_station_numbers,
    "s9_summary_round_trip": s9_summary_round_trip,
    "s5_refreshed_sales_by_region": s5_refreshed_sales_by_region,
    "p20_scaled_claims": p20_scaled_claims,
    "p22_negative_numeric_columns": p22_negative_numeric_columns,
}
