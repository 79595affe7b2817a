"""Web-event operators (CB1-CB11): funnels, per-visit summaries and campaign matching.

All per-visit work is one ``groupBy(visit)`` with conditional aggregates instead of
the source's seven re-scans of the event table joined back together; the campaign
match runs on the aggregated visits, not on raw events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import exact_pct


def visits_per_period(events: DataFrame, users: DataFrame, time_col: str, unit: str = "month") -> DataFrame:
    """Distinct visits per calendar ``unit`` for events of known cookies (CB3).

    ``left_semi`` keeps the inner-join filter (unknown cookies drop) without
    multiplying rows when a cookie appears twice in ``users``.
    """
    known = events.join(users.select("cookie_id"), "cookie_id", "left_semi")
    period = F.date_trunc(unit, F.col(time_col)).cast("date")
    return known.groupBy(period.alias(f"event_{unit}")).agg(
        F.count_distinct("visit_id").alias("unique_visit_count")
    )


def funnel(df: DataFrame, key: str, steps: Mapping[str, Column]) -> DataFrame:
    """Ordered funnel over keys (visits): how many keys reach each step, and the
    drop-off ``1 - n_k / n_(k-1)`` (CB6-CB8, CB11).

    One pass: per key, ``max`` of each step flag; then one global count per step.
    Returns one row per step: ``step, position, n_keys, pct_of_keys, drop_off``.
    """
    per_key = df.groupBy(key).agg(*[F.max(c.cast("int")).alias(name) for name, c in steps.items()])
    totals = per_key.agg(
        F.count(F.lit(1)).alias("_keys"),
        *[F.sum(name).alias(name) for name in steps],
    )
    names = list(steps)
    stacked = totals.select(
        "_keys",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i + 1).alias("position"), F.lit(n).alias("step"), F.col(n).alias("n_keys"),
                             (F.col(names[i - 1]) if i else F.col("_keys")).alias("_prev"))
                    for i, n in enumerate(names)
                ]
            )
        ).alias("s"),
    )
    return stacked.select(
        F.col("s.step").alias("step"),
        F.col("s.position").alias("position"),
        F.col("s.n_keys").alias("n_keys"),
        exact_pct(F.col("s.n_keys"), F.col("_keys"), 2).alias("pct_of_keys"),
        (F.lit(100.0) - exact_pct(F.col("s.n_keys"), F.col("s._prev"), 2)).alias("drop_off_pct"),
    )


def visit_summary(
    events: DataFrame,
    users: DataFrame,
    event_names: DataFrame,
    pages: DataFrame,
    campaigns: DataFrame,
) -> DataFrame:
    """One row per visit (and per matching campaign) (CB10).

    Columns: visit_id, user_id, earliest_visit, cart_products (pages added to cart in
    event order, ``', '``-separated, NULL if none), page_view_count, add_to_cart_count,
    purchase_flag, campaign_name, ad_impression_count.

    The source's purchase CTE is not grouped and so repeats each visit once per
    event; here ``purchase_flag`` is the per-visit ``max``.
    """
    e = (
        events.join(users.select("cookie_id", "user_id"), "cookie_id")
        .join(event_names, "event_type")
        .join(pages.select("page_id", "page_name"), "page_id", "left")
    )
    name = F.col("event_name")
    visits = e.groupBy("visit_id", "user_id").agg(
        F.min("event_time").cast("date").alias("earliest_visit"),
        F.expr(
            "listagg(CASE WHEN event_name = 'Add to Cart' THEN page_name END, ', ') "
            "WITHIN GROUP (ORDER BY sequence_number)"
        ).alias("cart_products")
        if "sequence_number" in events.columns
        else F.expr(
            "listagg(CASE WHEN event_name = 'Add to Cart' THEN page_name END, ', ') "
            "WITHIN GROUP (ORDER BY event_time, event_id)"
        ).alias("cart_products"),
        F.count_if(name == "Page View").alias("page_view_count"),
        F.count_if(name == "Add to Cart").alias("add_to_cart_count"),
        F.max((name == "Purchase").cast("int")).alias("purchase_flag"),
        F.count_if(name == "Ad Impression").alias("ad_impression_count"),
    )
    matched = match_campaigns(visits, campaigns, "earliest_visit", how="left")
    return matched.select(
        "visit_id",
        "user_id",
        "earliest_visit",
        "cart_products",
        "page_view_count",
        "add_to_cart_count",
        "purchase_flag",
        "campaign_name",
        "ad_impression_count",
    )


def match_campaigns(visits: DataFrame, campaigns: DataFrame, day_col: str, how: str = "left") -> DataFrame:
    """Campaign(s) whose ``[start_date, end_date]`` holds the visit day.

    Each campaign is expanded to its days and joined on the day; the exact range stays
    part of the condition.
    """
    c = campaigns.select("campaign_name", "start_date", "end_date").filter(F.col("start_date") <= F.col("end_date"))
    days = c.withColumn("_day", F.explode(F.sequence(F.col("start_date").cast("date"), F.col("end_date").cast("date"))))
    cond = (F.col(day_col).cast("date") == F.col("_day")) & F.col(day_col).between(F.col("start_date"), F.col("end_date"))
    return visits.join(days, cond, how).drop("_day", "start_date", "end_date")


def category_funnel(events: DataFrame, event_names: DataFrame, pages: DataFrame, level: str) -> DataFrame:
    """Views and cart adds per product page or category (CB11)."""
    e = events.join(event_names, "event_type").join(pages, "page_id")
    return (
        e.filter(F.col(level).isNotNull())
        .groupBy(level)
        .agg(
            F.count_if(F.col("event_name") == "Page View").alias("page_views"),
            F.count_if(F.col("event_name") == "Add to Cart").alias("cart_adds"),
        )
    )


def product_funnel(events: DataFrame, event_names: DataFrame, pages: DataFrame, level: str = "page_name") -> DataFrame:
    """Per product (or category): views, cart adds, adds that ended in a purchase in
    the same visit, abandoned adds, and the two conversion percentages (CB11).

    The per-visit purchase flag is an aggregate joined back on ``visit_id`` (a
    shuffle join that AQE can split for a hot visit), not a window over raw events.
    """
    e = events.join(event_names, "event_type")
    bought = e.groupBy("visit_id").agg(F.max((F.col("event_name") == "Purchase").cast("int")).alias("_bought"))
    prod = e.join(pages, "page_id").filter(F.col("product_category").isNotNull())
    prod = prod.join(bought, "visit_id")
    g = prod.groupBy(level).agg(
        F.count_if(F.col("event_name") == "Page View").alias("page_views"),
        F.count_if(F.col("event_name") == "Add to Cart").alias("cart_adds"),
        F.count_if((F.col("event_name") == "Add to Cart") & (F.col("_bought") == 1)).alias("purchases"),
    )
    return g.select(
        level,
        "page_views",
        "cart_adds",
        "purchases",
        (F.col("cart_adds") - F.col("purchases")).alias("abandoned"),
        exact_pct("cart_adds", "page_views", 2).alias("view_to_cart_pct"),
        exact_pct("purchases", "cart_adds", 2).alias("cart_to_purchase_pct"),
    )


def campaign_effect(summary: DataFrame) -> DataFrame:
    """Per campaign (NULL = no campaign): visits, averages of views / cart adds /
    impressions, and purchase rate (CB11 campaign analysis, over ``visit_summary``)."""
    return summary.groupBy("campaign_name").agg(
        F.count(F.lit(1)).alias("visits"),
        (F.sum("page_view_count").cast("double") / F.count(F.lit(1))).alias("avg_page_views"),
        (F.sum("add_to_cart_count").cast("double") / F.count(F.lit(1))).alias("avg_cart_adds"),
        (F.sum("ad_impression_count").cast("double") / F.count(F.lit(1))).alias("avg_impressions"),
        exact_pct(F.sum("purchase_flag"), F.count(F.lit(1)), 2).alias("purchase_rate_pct"),
    )
