"""Web-event queries (CB1-CB11) over the stand-in event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import exact_pct, exact_round_ratio
from ledgerline.operators.events import (
    campaign_effect,
    category_funnel,
    funnel,
    product_funnel,
    visit_summary,
    visits_per_period,
)
from ledgerline.operators.share import with_total
from ledgerline.plans.standins import campaigns, event_names, page_hierarchy, web_events, web_users


def _named(spark, d):
    return web_events(spark, d).join(event_names(spark), "event_type")


def cb1_user_count(spark: SparkSession, d: str) -> DataFrame:
    return web_users(spark, d).agg(F.count_distinct("user_id").alias("n_users"))


def cb2_cookies_per_user(spark: SparkSession, d: str) -> DataFrame:
    per_user = web_users(spark, d).groupBy("user_id").agg(F.count("cookie_id").alias("num_cookies"))
    agg = per_user.agg(
        F.sum("num_cookies").alias("total_cookies"), F.count_distinct("user_id").alias("n_users")
    )
    return agg.withColumn("avg_cookie_count", exact_round_ratio("total_cookies", "n_users", 2))


def cb3_visits_per_month(spark: SparkSession, d: str) -> DataFrame:
    return visits_per_period(web_events(spark, d), web_users(spark, d), "event_time", "month")


def cb3_visits_per_day(spark: SparkSession, d: str) -> DataFrame:
    return visits_per_period(web_events(spark, d), web_users(spark, d), "event_time", "day")


def cb4_events_per_type(spark: SparkSession, d: str) -> DataFrame:
    return (
        _named(spark, d)
        .groupBy("event_type", "event_name")
        .agg(F.count("event_type").alias("n_events"))
        .orderBy("event_type")
    )


def cb5_event_share(spark: SparkSession, d: str) -> DataFrame:
    g = _named(spark, d).groupBy("event_name").agg(F.count("visit_id").alias("total_visits_per_event"))
    out = with_total(g, "total_visits_per_event", name="total_visits")
    ratio = F.col("total_visits_per_event").cast("decimal(20,0)") / F.col("total_visits").cast("decimal(20,0)")
    return out.withColumn("perc_visit", F.round(F.round(ratio, 4) * 100, 2).cast("double"))


def cb6_purchase_visit_pct(spark: SparkSession, d: str) -> DataFrame:
    # left join: the denominator counts the visits of every event, named or not
    e = web_events(spark, d).join(event_names(spark), "event_type", "left")
    per_visit = e.groupBy("visit_id").agg(F.max(F.col("event_name") == "Purchase").alias("_bought"))
    agg = per_visit.agg(
        F.count_if(F.col("_bought") & F.col("visit_id").isNotNull()).alias("_p"), F.count("visit_id").alias("_v")
    )
    return agg.select(F.expr("(_p * 100) div _v").alias("purchase_visit_pct"))


def cb7_purchase_pct_by_flags(spark: SparkSession, d: str) -> DataFrame:
    per_visit = _named(spark, d).groupBy("visit_id").agg(
        F.count_if(F.col("event_name") == "Purchase").alias("purchase_event")
    )
    return per_visit.agg(exact_pct(F.sum("purchase_event"), F.count(F.lit(1)), 2).alias("purchase_perc"))


def cb8_checkout_no_purchase_pct(spark: SparkSession, d: str) -> DataFrame:
    e = _named(spark, d).join(page_hierarchy(spark), "page_id")
    per_visit = e.groupBy("visit_id").agg(
        F.count_if((F.col("event_name") == "Page View") & (F.col("page_name") == "Checkout")).alias("checkout_count"),
        F.count_if((F.col("event_name") == "Purchase") & (F.col("page_name") == "Confirmation")).alias(
            "purchase_count"
        ),
    )
    hit = (F.col("checkout_count") == 1) & (F.col("purchase_count") == 0)
    return per_visit.agg(exact_pct(F.count_if(hit), F.count(F.lit(1)), 2).alias("perc_no_purchase"))


def cb9_top3_pages(spark: SparkSession, d: str) -> DataFrame:
    e = web_events(spark, d).filter(F.col("event_type") == 1).join(page_hierarchy(spark), "page_id")
    g = e.groupBy("page_name").agg(F.count(F.lit(1)).alias("n_views"))
    return g.orderBy(F.col("n_views").desc(), F.col("page_name")).limit(3)


def cb10_visit_summary(spark: SparkSession, d: str) -> DataFrame:
    return visit_summary(
        web_events(spark, d), web_users(spark, d), event_names(spark), page_hierarchy(spark), campaigns(spark)
    )


def cb11_category_views_adds(spark: SparkSession, d: str) -> DataFrame:
    return category_funnel(web_events(spark, d), event_names(spark), page_hierarchy(spark), "product_category")


def cb11_product_funnel(spark: SparkSession, d: str) -> DataFrame:
    return product_funnel(web_events(spark, d), event_names(spark), page_hierarchy(spark), "page_name")


def cb11_campaign_effect(spark: SparkSession, d: str) -> DataFrame:
    return campaign_effect(cb10_visit_summary(spark, d))


def cb_visit_funnel(spark: SparkSession, d: str) -> DataFrame:
    e = _named(spark, d).join(page_hierarchy(spark), "page_id", "left")
    name, page = F.col("event_name"), F.col("page_name")
    steps = {
        "product_view": (name == "Page View") & F.col("product_category").isNotNull(),
        "cart_add": name == "Add to Cart",
        "checkout_view": (name == "Page View") & (page == "Checkout"),
        "purchase": name == "Purchase",
    }
    return funnel(e, "visit_id", steps)


QUERIES = {
    "cb1_user_count": cb1_user_count,
    "cb2_cookies_per_user": cb2_cookies_per_user,
    "cb3_visits_per_month": cb3_visits_per_month,
    "cb3_visits_per_day": cb3_visits_per_day,
    "cb4_events_per_type": cb4_events_per_type,
    "cb5_event_share": cb5_event_share,
    "cb6_purchase_visit_pct": cb6_purchase_visit_pct,
    "cb7_purchase_pct_by_flags": cb7_purchase_pct_by_flags,
    "cb8_checkout_no_purchase_pct": cb8_checkout_no_purchase_pct,
    "cb9_top3_pages": cb9_top3_pages,
    "cb10_visit_summary": cb10_visit_summary,
    "cb11_category_views_adds": cb11_category_views_adds,
    "cb11_product_funnel": cb11_product_funnel,
    "cb11_campaign_effect": cb11_campaign_effect,
    "cb_visit_funnel": cb_visit_funnel,
}
