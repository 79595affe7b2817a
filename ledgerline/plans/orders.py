"""E-commerce queries (EC1-EC23) over the stand-in order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import exact_pct, exact_ratio
from ledgerline.operators.encode import category_dictionary, flag_totals, one_hot
from ledgerline.operators.orders import (
    LEAD_COLUMNS,
    clean_orders,
    clean_products,
    date_order_rules,
    item_aggregate,
    lead_bin,
    model_table,
    payment_features,
    price_bin,
    review_category,
    review_class_name,
    volume_class,
    with_lead_times,
)
from ledgerline.operators.profile import (
    box_stats,
    describe,
    duplicate_rows,
    histogram,
    negative_columns,
    profile_table,
    violation_rates,
)
from ledgerline.operators.share import percent_distribution, pivot_counts, value_counts, with_total
from ledgerline.plans import standins as S
from ledgerline.sources.store import shared_table


def mean_exact(c: str) -> Column:
    """Mean of an exact (decimal / integer) column: exact sum to double, one division."""
    return F.sum(c).cast("double") / F.count(c)


def build_model(spark: SparkSession, d: str) -> DataFrame:
    m = model_table(
        S.ec_orders(spark, d),
        S.ec_customers(spark, d),
        S.ec_payments(spark, d),
        S.ec_items(spark, d),
        S.ec_products(spark, d),
        S.ec_category_translation(spark, d),
        S.ec_reviews(spark, d),
        S.ec_sellers(spark, d),
    )
    return m.withColumn("review_category", review_category("review_score"))


def _model(spark, d) -> DataFrame:
    """The modelling table as written by the first query that needs it, by review class (EC13)."""
    return shared_table(spark, "ec_model", d, lambda: build_model(spark, d), ["review_category"])


# ----------------------------------------------------------------------- payments

def ec1_profile_payments(spark: SparkSession, d: str) -> DataFrame:
    return profile_table(S.ec_payments(spark, d))


def ec1_describe_payments(spark: SparkSession, d: str) -> DataFrame:
    return describe(S.ec_payments(spark, d), ["payment_sequential", "payment_installments", "payment_value"])


def ec1_duplicates_payments(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_rows(S.ec_payments(spark, d))


def ec1_profile_products(spark: SparkSession, d: str) -> DataFrame:
    return profile_table(S.ec_products(spark, d))


def ec1_payment_value_histogram(spark: SparkSession, d: str) -> DataFrame:
    return histogram(S.ec_payments(spark, d), "payment_value", 20)


def _payments(spark, d):
    return S.ec_payments(spark, d).filter(~F.col("payment_type").eqNullSafe("not_defined"))


def ec2_payment_count_distribution(spark: SparkSession, d: str) -> DataFrame:
    per_order = _payments(spark, d).groupBy("order_id").agg(
        F.count_distinct("payment_sequential").alias("payment_count"),
        F.sum("payment_value").alias("_value"),
    )
    g = per_order.groupBy("payment_count").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("_value").alias("_value")
    )
    g = with_total(g, "order_count", name="_orders")
    return g.select(
        "payment_count",
        "order_count",
        F.col("_value").cast("double").alias("total_payment_value"),
        exact_pct("order_count", "_orders", 2).alias("pct_orders"),
    ).orderBy("payment_count")


def ec3_payment_type_by_sequence(spark: SparkSession, d: str) -> DataFrame:
    p = _payments(spark, d).filter(F.col("payment_sequential").isin(1, 2))
    return p.groupBy("payment_sequential", "payment_type").agg(F.count("payment_value").alias("n_payments"))


def ec4_installment_distribution(spark: SparkSession, d: str) -> DataFrame:
    p = _payments(spark, d).filter(~F.col("payment_installments").eqNullSafe(0))
    return p.groupBy("payment_installments").agg(F.count(F.lit(1)).alias("n_payments")).orderBy(
        "payment_installments"
    )


def ec5_payment_totals_by_type(spark: SparkSession, d: str) -> DataFrame:
    p = _payments(spark, d)
    tot = p.groupBy("payment_type").agg(F.sum("payment_value").cast("double").alias("total_payment_value"))
    desc = describe(p, ["payment_value"], by=["payment_type"]).drop("column_name")
    return tot.join(desc, "payment_type")


def ec5_order_value_describe(spark: SparkSession, d: str) -> DataFrame:
    """Describe the orders' payment totals, with the grand total."""
    per_order = _payments(spark, d).groupBy("order_id").agg(F.sum("payment_value").alias("order_value"))
    total = per_order.agg(F.sum("order_value").cast("double").alias("grand_total")).withColumn("_one", F.lit(1))
    desc = describe(per_order, ["order_value"]).withColumn("_one", F.lit(1))
    return desc.join(F.broadcast(total), "_one").drop("_one")


def ec5_describe_by_type_and_installments(spark: SparkSession, d: str) -> DataFrame:
    keys = ["payment_type", "payment_installments"]
    return describe(_payments(spark, d), ["payment_value"], by=keys).drop("column_name")


def ec6_order_payment_features(spark: SparkSession, d: str) -> DataFrame:
    f = payment_features(_payments(spark, d))
    return f.withColumn("total_payment_value", F.col("total_payment_value").cast("double"))


def ec6_payment_flag_shares(spark: SparkSession, d: str) -> DataFrame:
    """Percent of orders using each payment type (A29): one aggregate of the flags."""
    f = payment_features(_payments(spark, d))
    return f.agg(*[exact_pct(F.sum(f"is_{t}"), F.count(F.lit(1)), 2).alias(f"pct_{t}")
                   for t in ("boleto", "credit_card", "debit_card", "voucher")])


# ----------------------------------------------------------------------- products / orders

def _products(spark, d):
    return clean_products(S.ec_products(spark, d), S.ec_category_translation(spark, d))


def ec7_clean_products(spark: SparkSession, d: str) -> DataFrame:
    return _products(spark, d)


# The categories that the fill rules translate; others without a translation stay NULL.
FILL_RULES = {"promo_ring": "promo ring", "promo_rod": "promo rod"}


def ec7_filled_products(spark: SparkSession, d: str) -> DataFrame:
    """The products with the two fill rules only, as the source fills them (P10)."""
    return clean_products(S.ec_products(spark, d), S.ec_category_translation(spark, d), FILL_RULES)


def _flagged(spark, d):
    p = _products(spark, d)
    dictionary = category_dictionary(p, "product_category_name_english")
    return one_hot(p, "product_category_name_english", dictionary), list(dictionary)


def ec7_category_flags(spark: SparkSession, d: str) -> DataFrame:
    """How many products each data-driven 0/1 column marks."""
    return flag_totals(*_flagged(spark, d))


def ec7_flags_by_photos(spark: SparkSession, d: str) -> DataFrame:
    """The 0/1 columns summed by number of photos, in long form."""
    wide, names = _flagged(spark, d)
    g = wide.groupBy("product_photos_qty").agg(*[F.sum(F.col(f"`{c}`")).alias(f"_s{i}") for i, c in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(f"_s{i}").alias("n_ones")) for i, c in enumerate(names)])
    return g.select("product_photos_qty", F.explode(cells).alias("_c")).select("_c.flag", "product_photos_qty", "_c.n_ones")


def ec8_photo_distribution(spark: SparkSession, d: str) -> DataFrame:
    return percent_distribution(_products(spark, d), "product_photos_qty")


def ec9_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return value_counts(S.ec_orders(spark, d), "order_status")


def ec9_date_violations(spark: SparkSession, d: str) -> DataFrame:
    return violation_rates(S.ec_orders(spark, d), date_order_rules())


def ec9_clean_orders(spark: SparkSession, d: str) -> DataFrame:
    return clean_orders(S.ec_orders(spark, d)).select("order_id", "customer_id", *LEAD_COLUMNS)


def ec9_negative_lead_times(spark: SparkSession, d: str) -> DataFrame:
    return negative_columns(with_lead_times(S.ec_orders(spark, d)), list(LEAD_COLUMNS))


def ec10_item_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return item_aggregate(S.ec_items(spark, d)).withColumn("price", F.col("price").cast("double"))


def ec11_customer_counts(spark: SparkSession, d: str) -> DataFrame:
    c = S.ec_customers(spark, d)
    per = c.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("_n"))
    rep = per.agg(
        F.count(F.lit(1)).alias("n_unique_customers"),
        F.sum("_n").alias("n_purchases"),
        F.count_if(F.col("_n") > 1).alias("n_repeat_customers"),
    )
    geo = c.agg(F.count_distinct("customer_city").alias("n_cities"), F.count_distinct("customer_state").alias("n_states"))
    rep = rep.withColumn("_one", F.lit(1)).join(F.broadcast(geo.withColumn("_one", F.lit(1))), "_one").drop("_one")
    return rep.withColumn("repeat_customer_pct", exact_pct("n_repeat_customers", "n_unique_customers", 2))


def ec12_sellers_per_state(spark: SparkSession, d: str) -> DataFrame:
    return S.ec_sellers(spark, d).groupBy("seller_state").agg(F.count(F.lit(1)).alias("n_sellers"))


# ----------------------------------------------------------------------- modelling table analyses

def ec13_model_table(spark: SparkSession, d: str) -> DataFrame:
    return _model(spark, d).withColumns(
        {"total_payment_value": F.col("total_payment_value").cast("double"), "price": F.col("price").cast("double")}
    )


def ec14_review_categories(spark: SparkSession, d: str) -> DataFrame:
    return _model(spark, d).groupBy("review_category").agg(F.count(F.lit(1)).alias("n_reviews"))


def ec15_payment_by_score(spark: SparkSession, d: str) -> DataFrame:
    g = _model(spark, d).groupBy("review_score").agg(F.sum("total_payment_value").alias("_v"))
    g = with_total(g, "_v", name="_t")
    good = g.agg(F.sum(F.when(F.col("review_score") >= 4, F.col("_v"))).alias("_good")).withColumn("_one", F.lit(1))
    g = g.withColumn("_one", F.lit(1)).join(F.broadcast(good), "_one")
    def ratio(a, b):
        return F.round(exact_ratio(a, b, 2) * 100, 2)

    return g.select(
        "review_score",
        F.col("_v").cast("double").alias("total_payment_value"),
        ratio(F.col("_v"), F.col("_t")).cast("double").alias("pct_of_value"),
        ratio(F.col("_good"), F.col("_t")).cast("double").alias("pct_value_in_4_5"),
    )


def ec16_category_review_pivot_top10(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d).filter(F.col("review_score").isNotNull() & F.col("product_category_name_english").isNotNull())
    p = pivot_counts(m, "product_category_name_english", "review_category", [0, 1, 2], total="total_reviews")
    p = p.select(
        "product_category_name_english",
        F.col("`0`").alias("n_bad"),
        F.col("`1`").alias("n_neutral"),
        F.col("`2`").alias("n_good"),
        "total_reviews",
    )
    return p.orderBy(F.col("total_reviews").desc(), "product_category_name_english").limit(10)


def _scores_by_category(m: DataFrame) -> DataFrame:
    return m.groupBy("product_category_name_english").agg(
        F.avg("review_score").alias("mean_score"),
        F.count("review_id").alias("n_reviews"),
        F.stddev_samp("review_score").alias("std_score"),
        F.count(F.lit(1)).alias("_rows"),
    )


def _category_scores(spark, d):
    m = _model(spark, d).filter(F.col("product_category_name_english").isNotNull())
    return _scores_by_category(m).drop("_rows")


def ec17_category_scores(spark: SparkSession, d: str) -> DataFrame:
    return _category_scores(spark, d)


def ec17_top10_by_count(spark: SparkSession, d: str) -> DataFrame:
    return _category_scores(spark, d).orderBy(F.col("n_reviews").desc(), "product_category_name_english").limit(10)


def ec17_bottom10_by_mean(spark: SparkSession, d: str) -> DataFrame:
    return _category_scores(spark, d).orderBy(F.col("mean_score").asc(), "product_category_name_english").limit(10)


def ec17_top5_std_share(spark: SparkSession, d: str) -> DataFrame:
    """The five categories whose scores vary most, and their share of all rows, those without a category included."""
    s = with_total(_scores_by_category(_model(spark, d)), "_rows", name="_all")
    s = s.filter(F.col("product_category_name_english").isNotNull())
    s = s.withColumn("pct_of_orders", exact_pct("n_reviews", "_all", 2))
    return s.select("product_category_name_english", "std_score", "n_reviews", "pct_of_orders").orderBy(
        F.col("std_score").desc_nulls_last(), "product_category_name_english"
    ).limit(5)


def ec18_lead_by_score(spark: SparkSession, d: str) -> DataFrame:
    return _model(spark, d).groupBy("review_score").agg(F.avg("delivery_minus_purchase").alias("mean_delivery_days"))


def ec18_lead_by_category_top10(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d).filter(F.col("product_category_name_english").isNotNull())
    g = m.groupBy("product_category_name_english").agg(
        F.avg("delivery_minus_purchase").alias("mean_delivery_days"), F.count("review_id").alias("n_reviews")
    )
    return g.orderBy(
        F.col("mean_delivery_days").desc_nulls_last(), F.col("n_reviews").desc(), "product_category_name_english"
    ).limit(10)


def ec19_payment_price_by_class(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d)
    return m.groupBy(review_class_name("review_category").alias("review_class")).agg(
        mean_exact("total_payment_value").alias("mean_payment_value"),
        mean_exact("price").alias("mean_price"),
    )


def ec19_score_by_same_state(spark: SparkSession, d: str) -> DataFrame:
    return _model(spark, d).groupBy("state_is_equal").agg(F.avg("review_score").alias("mean_score"))


def ec20_customers_sellers_by_score(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d)
    return m.groupBy("review_score").agg(
        F.count("customer_id").alias("n_customers"), F.count("seller_id").alias("n_sellers")
    )


def ec20_share_in_top_scores(spark: SparkSession, d: str) -> DataFrame:
    """Percent of customers and of sellers among reviews with a score of 4 or 5."""
    g = ec20_customers_sellers_by_score(spark, d)
    top = F.col("review_score") >= 4
    return g.agg(*[
        exact_pct(F.sum(F.when(top, F.col(f"n_{x}")).otherwise(0)), F.sum(f"n_{x}"), 2).alias(f"pct_{x}")
        for x in ("customers", "sellers")
    ])


def ec21_neutral_vs_positive_leads(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d).filter(F.col("review_category").isin(1, 2))
    return m.groupBy(review_class_name("review_category").alias("review_class")).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in LEAD_COLUMNS]
    )


def ec22_score_by_lead_bin(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d)
    measures = ["days_purchase_to_approved", "days_approved_to_carrier", "days_carrier_to_customer",
                "delivery_minus_purchase"]
    stacked = m.select(
        "review_score",
        F.explode(F.array(*[F.struct(F.lit(c).alias("lead_measure"), lead_bin(c).alias("lead_bin")) for c in measures])).alias("_s"),
    ).select("review_score", "_s.*")
    return stacked.filter(F.col("lead_bin").isNotNull()).groupBy("lead_measure", "lead_bin").agg(
        F.avg("review_score").alias("mean_score"), F.count(F.lit(1)).alias("n_reviews")
    )


def ec23_score_box_by_volume(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d).withColumn("volume_category", volume_class("volume_cm3"))
    return box_stats(m, "review_score", ["volume_category"])


def ec23_score_box_by_price_bin(spark: SparkSession, d: str) -> DataFrame:
    m = _model(spark, d).withColumn("price_bin", price_bin("price")).filter(F.col("price_bin").isNotNull())
    return box_stats(m, "review_score", ["price_bin"])


QUERIES = {
    "ec1_profile_payments": ec1_profile_payments,
    "ec1_describe_payments": ec1_describe_payments,
    "ec1_duplicates_payments": ec1_duplicates_payments,
    "ec1_profile_products": ec1_profile_products,
    "ec1_payment_value_histogram": ec1_payment_value_histogram,
    "ec2_payment_count_distribution": ec2_payment_count_distribution,
    "ec3_payment_type_by_sequence": ec3_payment_type_by_sequence,
    "ec4_installment_distribution": ec4_installment_distribution,
    "ec5_payment_totals_by_type": ec5_payment_totals_by_type,
    "ec5_order_value_describe": ec5_order_value_describe,
    "ec5_describe_by_type_and_installments": ec5_describe_by_type_and_installments,
    "ec6_order_payment_features": ec6_order_payment_features,
    "ec6_payment_flag_shares": ec6_payment_flag_shares,
    "ec7_clean_products": ec7_clean_products,
    "ec7_filled_products": ec7_filled_products,
    "ec7_category_flags": ec7_category_flags,
    "ec7_flags_by_photos": ec7_flags_by_photos,
    "ec8_photo_distribution": ec8_photo_distribution,
    "ec9_status_counts": ec9_status_counts,
    "ec9_date_violations": ec9_date_violations,
    "ec9_clean_orders": ec9_clean_orders,
    "ec9_negative_lead_times": ec9_negative_lead_times,
    "ec10_item_aggregate": ec10_item_aggregate,
    "ec11_customer_counts": ec11_customer_counts,
    "ec12_sellers_per_state": ec12_sellers_per_state,
    "ec13_model_table": ec13_model_table,
    "ec14_review_categories": ec14_review_categories,
    "ec15_payment_by_score": ec15_payment_by_score,
    "ec16_category_review_pivot_top10": ec16_category_review_pivot_top10,
    "ec17_category_scores": ec17_category_scores,
    "ec17_top10_by_count": ec17_top10_by_count,
    "ec17_bottom10_by_mean": ec17_bottom10_by_mean,
    "ec17_top5_std_share": ec17_top5_std_share,
    "ec18_lead_by_score": ec18_lead_by_score,
    "ec18_lead_by_category_top10": ec18_lead_by_category_top10,
    "ec19_payment_price_by_class": ec19_payment_price_by_class,
    "ec19_score_by_same_state": ec19_score_by_same_state,
    "ec20_customers_sellers_by_score": ec20_customers_sellers_by_score,
    "ec20_share_in_top_scores": ec20_share_in_top_scores,
    "ec21_neutral_vs_positive_leads": ec21_neutral_vs_positive_leads,
    "ec22_score_by_lead_bin": ec22_score_by_lead_bin,
    "ec23_score_box_by_volume": ec23_score_box_by_volume,
    "ec23_score_box_by_price_bin": ec23_score_box_by_price_bin,
}
