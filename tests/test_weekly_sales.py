"""Unit tests for the weekly-sales operators on small literal frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions.columns import day_name, parse_dmy_2digit
from ledgerline.operators.impact import impact_by, impact_by_year, missing_periods, period_totals
from ledgerline.operators.share import ratio_of_sums, share_of_total
from ledgerline.plans.standins import clean_weekly_sales

SALES_SCHEMA = (
    "week_date string, region string, platform string, segment string, customer_type string, "
    "transactions bigint, sales decimal(18,2)"
)


def _sales(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def test_unpadded_dates_and_century(spark):
    df = spark.createDataFrame([("31/8/20",), ("1/1/95",), ("9/12/69",), ("15/06/70",)], "s string")
    got = [r[0] for r in df.select(parse_dmy_2digit("s")).collect()]
    assert got == [dt.date(2020, 8, 31), dt.date(1995, 1, 1), dt.date(2069, 12, 9), dt.date(1970, 6, 15)]


def test_segment_codes_and_zero_transactions(spark):
    rows = [
        ("31/8/20", "ASIA", "Retail", "C1", "New", 10, Decimal("100.00")),
        ("31/8/20", "ASIA", "Retail", "F2", "New", 3, Decimal("10.00")),
        ("31/8/20", "ASIA", "Retail", "C3", "New", 1, Decimal("1.00")),
        ("31/8/20", "ASIA", "Retail", "F4", "New", 1, Decimal("1.00")),
        ("31/8/20", "ASIA", "Retail", None, "New", 1, Decimal("1.00")),
        ("31/8/20", "ASIA", "Retail", "null", "New", 0, Decimal("5.00")),
    ]
    out = clean_weekly_sales(_sales(spark, rows)).collect()
    by_seg = {r.segment: r for r in out}
    assert by_seg["C1"].demographic_segment == "Couples" and by_seg["C1"].age_band == "Young Adults"
    assert by_seg["F2"].demographic_segment == "Families" and by_seg["F2"].age_band == "Middle Aged"
    assert by_seg["C3"].age_band == "Retirees"
    assert by_seg["F4"].age_band == "unknown"  # as written: '= 3 or = 3'
    assert by_seg[None].demographic_segment == "unknown" and by_seg[None].clean_segment_number is None
    assert by_seg["null"].clean_segment_number is None
    assert by_seg["null"].avg_transactions is None  # 5 / 0 -> NULL, not an error
    assert by_seg["F2"].avg_transactions == 3.33
    assert by_seg["C1"].week_number == 36 and by_seg["C1"].calendar_year == 2020
    assert by_seg["C1"].month_number == 8


def test_half_up_rounding_on_ties(spark):
    # 1/8 = 0.125 -> 0.13 (HALF_UP), a double round would give 0.12 in one engine or the other
    df = spark.createDataFrame([(1, Decimal("1.00"), 8)], "k int, s decimal(18,2), t bigint")
    got = df.groupBy("k").agg(ratio_of_sums("s", "t", 2).cast("double").alias("r")).first().r
    assert got == 0.13


def test_before_after_periods(spark):
    weeks = [(13, 10), (24, 30), (25, 20), (36, 40), (12, 999), (37, 999)]
    rows = [(w, Decimal(s), "X") for w, s in weeks]
    df = spark.createDataFrame(rows, "week_number int, sales decimal(18,2), region string")
    out = period_totals(df, "week_number", (13, 24), (25, 36)).collect()
    assert [r.time_period for r in out] == ["before", "after"]
    assert out[0].prev_total_sales is None
    assert out[1].total_sales == 60.0 and out[1].prev_total_sales == 40.0 and out[1].sales_diff == 20.0
    assert out[1].rate_before_after == 50.0


def test_equal_periods_give_null_rate(spark):
    rows = [(21, Decimal("5.00")), (25, Decimal("5.00"))]
    df = spark.createDataFrame(rows, "week_number int, sales decimal(18,2)")
    out = period_totals(df, "week_number", (21, 24), (25, 28)).collect()
    assert out[1].rate_before_after is None


def test_impact_by_dimension_drops_one_sided_keys(spark):
    rows = [
        ("A", 14, Decimal("100.00")),
        ("A", 30, Decimal("90.00")),
        ("B", 14, Decimal("50.00")),  # before only -> dropped
        ("C", 30, Decimal("50.00")),  # after only -> dropped
    ]
    df = spark.createDataFrame(rows, "region string, week_number int, sales decimal(18,2)")
    out = impact_by(df, "region").collect()
    assert [(r.region, r.perc_diff_sales, r.diff_sales) for r in out] == [("A", -10.0, -10.0)]


def test_yearly_change_skips_year_without_before(spark):
    rows = [
        (2019, 21, Decimal("10.00")),
        (2019, 25, Decimal("11.00")),
        (2020, 25, Decimal("7.00")),  # no before rows
        (2018, 22, Decimal("3.00")),
        (2018, 26, Decimal("3.00")),  # no change -> dropped by diff != 0
    ]
    df = spark.createDataFrame(rows, "calendar_year int, week_number int, sales decimal(18,2)")
    out = impact_by_year(df, [2018, 2019, 2020]).collect()
    assert [(r.calendar_year, r.perc_sales_change) for r in out] == [(2019, 10.0)]


def test_missing_periods(spark):
    df = spark.createDataFrame([(w,) for w in range(1, 53) if w not in (5, 52)], "week_number int")
    assert [r[0] for r in missing_periods(df, "week_number").collect()] == [5, 52]


def test_share_of_total_identity(spark):
    rows = [("Retail", 1, Decimal("30.00")), ("Retail", 1, Decimal("30.00")), ("Shopify", 1, Decimal("40.00"))]
    df = spark.createDataFrame(rows, "platform string, m int, sales decimal(18,2)")
    out = {r.platform: r.share for r in share_of_total(df, ["platform", "m"], ["m"], round_to=3).collect()}
    assert out == {"Retail": 60.0, "Shopify": 40.0}


def test_day_names(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 15),)], "d date")
    assert df.select(day_name("d", padded=True)).first()[0] == "monday   "


def test_written_table_round_trip(spark):
    """The cleaned table persisted (partitioned by year) and read back whole."""
    import tempfile

    from ledgerline.sources.tables import write_table

    rows = [("31/8/20", "ASIA", "Retail", "C1", "New", 10, Decimal("100.00")),
            ("1/1/19", "ASIA", "Retail", "F2", "New", 3, Decimal("10.00"))]
    clean = clean_weekly_sales(_sales(spark, rows))
    path = tempfile.mkdtemp(prefix="ledgerline-test-table-", dir="/tmp") + "/clean_weekly_sales"
    write_table(clean, path, partition_by=["calendar_year"])
    back = spark.read.parquet(path)
    assert back.count() == 2 and sorted(r.calendar_year for r in back.collect()) == [2019, 2020]


def test_standardize(spark):
    from ledgerline.operators.stats import standardize

    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    assert [r.z for r in standardize(df, ["x"], "").select(F.col("x").alias("z")).orderBy("z").collect()] == [-1.0, 0.0, 1.0]


def test_to_numeric_coerce(spark):
    import pytest

    from ledgerline.functions.columns import to_numeric

    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(to_numeric("s", coerce=True)).collect()] == [1.5, None, None]
    with pytest.raises(Exception):
        df.select(to_numeric("s")).collect()
