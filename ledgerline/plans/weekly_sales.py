"""Weekly-sales queries (DM1-DM19) over the stand-in weekly-sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import day_name
from ledgerline.operators.impact import (
    impact_all_dims,
    impact_by,
    impact_by_year,
    missing_periods,
    period_totals,
)
from ledgerline.operators.share import ratio_of_sums, share_of_total
from ledgerline.plans.standins import clean_sales, weekly_sales

BASELINE_YEAR = 2000  # the test data ends in 2001-08, so the "week 25" change is placed in 2000
COMPARE_YEARS = (1998, 1999, 2000)
DIMENSIONS = ("region", "platform", "age_band", "demographic_segment", "customer_type")


def dm1_clean_weekly_sales(spark: SparkSession, d: str) -> DataFrame:
    return clean_sales(spark, d).withColumn("sales", F.col("sales").cast("double"))


def dm2_week_day_names(spark: SparkSession, d: str) -> DataFrame:
    c = clean_sales(spark, d)
    return c.select("clean_week_date", day_name("clean_week_date", padded=True).alias("week_day")).orderBy(
        "clean_week_date"
    )


def dm3_missing_weeks(spark: SparkSession, d: str) -> DataFrame:
    return missing_periods(clean_sales(spark, d), "week_number", 1, 52)


def dm3_missing_weeks_2001(spark: SparkSession, d: str) -> DataFrame:
    c = clean_sales(spark, d, (2001,))
    return missing_periods(c, "week_number", 1, 52)


def dm4_yearly_transactions(spark: SparkSession, d: str) -> DataFrame:
    return clean_sales(spark, d).groupBy("calendar_year").agg(
        F.count(F.lit(1)).alias("total_trx_count"), F.sum("transactions").alias("total_trx")
    )


def dm5_region_month_sales_top7(spark: SparkSession, d: str) -> DataFrame:
    g = clean_sales(spark, d).groupBy("region", "calendar_year", "month_number").agg(
        F.sum("sales").cast("double").alias("total_sales")
    )
    return g.orderBy("calendar_year", "month_number", "region").limit(7)


def dm6_platform_transactions(spark: SparkSession, d: str) -> DataFrame:
    return weekly_sales(spark, d).groupBy("platform").agg(F.sum("transactions").alias("total_transactions"))


def dm7_platform_share_monthly(spark: SparkSession, d: str) -> DataFrame:
    s = share_of_total(
        clean_sales(spark, d),
        by=["platform", "calendar_year", "month_number"],
        within=["calendar_year", "month_number"],
        round_to=3,
        name="perc_per_platform",
    )
    return s.select("platform", "calendar_year", "month_number", "perc_per_platform").orderBy(
        "calendar_year", "month_number", "platform"
    )


def dm8_demographic_share_yearly(spark: SparkSession, d: str) -> DataFrame:
    s = share_of_total(
        clean_sales(spark, d),
        by=["demographic_segment", "calendar_year"],
        within=["calendar_year"],
        round_to=2,
        name="perc_per_dem",
    )
    return s.select(
        "demographic_segment",
        "calendar_year",
        "perc_per_dem",
        F.col("_part").cast("double").alias("sales_per_dem"),
    ).orderBy("calendar_year", "demographic_segment")


def dm9_retail_age_demo_share(spark: SparkSession, d: str) -> DataFrame:
    retail = clean_sales(spark, d).filter(F.col("platform") == "Retail")
    s = share_of_total(retail, by=["age_band", "demographic_segment"], round_to=2, name="total_sales_pc")
    return s.select("age_band", "demographic_segment", "total_sales_pc").orderBy(
        F.col("total_sales_pc").desc(), "age_band", "demographic_segment"
    )


def dm10_avg_transaction(spark: SparkSession, d: str) -> DataFrame:
    g = clean_sales(spark, d).groupBy("calendar_year", "platform").agg(
        ratio_of_sums("sales", "transactions", 2).cast("double").alias("avg_annual_transaction")
    )
    return g.orderBy("calendar_year", "platform")


def _year(spark, d):
    return clean_sales(spark, d, (BASELINE_YEAR,))


def dm11_before_after_4w(spark: SparkSession, d: str) -> DataFrame:
    return period_totals(_year(spark, d), "week_number", (21, 24), (25, 28))


def dm12_before_after_12w(spark: SparkSession, d: str) -> DataFrame:
    return period_totals(_year(spark, d), "week_number", (13, 24), (25, 36))


def dm13_yearly_change_4w(spark: SparkSession, d: str) -> DataFrame:
    return impact_by_year(clean_sales(spark, d, COMPARE_YEARS), COMPARE_YEARS, "week_number", (21, 24), (25, 28))


def dm14_yearly_change_12w(spark: SparkSession, d: str) -> DataFrame:
    return impact_by_year(clean_sales(spark, d, COMPARE_YEARS), COMPARE_YEARS, "week_number", (13, 24), (25, 36))


def _impact(dim: str, style: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return impact_by(_year(spark, d), dim, style=style)

    run.__name__ = f"impact_{dim}"
    return run


def dm_impact_all_dimensions(spark: SparkSession, d: str) -> DataFrame:
    return impact_all_dims(_year(spark, d), DIMENSIONS)


QUERIES = {
    "dm1_clean_weekly_sales": dm1_clean_weekly_sales,
    "dm2_week_day_names": dm2_week_day_names,
    "dm3_missing_weeks": dm3_missing_weeks,
    "dm3_missing_weeks_2001": dm3_missing_weeks_2001,
    "dm4_yearly_transactions": dm4_yearly_transactions,
    "dm5_region_month_sales_top7": dm5_region_month_sales_top7,
    "dm6_platform_transactions": dm6_platform_transactions,
    "dm7_platform_share_monthly": dm7_platform_share_monthly,
    "dm8_demographic_share_yearly": dm8_demographic_share_yearly,
    "dm9_retail_age_demo_share": dm9_retail_age_demo_share,
    "dm10_avg_transaction": dm10_avg_transaction,
    "dm11_before_after_4w": dm11_before_after_4w,
    "dm12_before_after_12w": dm12_before_after_12w,
    "dm13_yearly_change_4w": dm13_yearly_change_4w,
    "dm14_yearly_change_12w": dm14_yearly_change_12w,
    "dm15_impact_by_region": _impact("region", "r3x100"),
    "dm16_impact_by_platform": _impact("platform", "r3x100"),
    "dm17_impact_by_age_band": _impact("age_band", "r3x100"),
    "dm18_impact_by_demographic": _impact("demographic_segment", "r4x100"),
    "dm19_impact_by_customer_type": _impact("customer_type", "r4x100"),
    "dm_impact_all_dimensions": dm_impact_all_dimensions,
}
