"""Order, payment, product and review features (EC2-EC23).

Joins are written so that Spark shuffles each large input once on ``order_id`` and
reuses that partitioning for every ``order_id`` join; the per-order aggregates are
computed before joining (partial aggregation map-side), so the star join only ever
sees one row per order from each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import bin_left_closed, bin_right_closed, flag, lead_days, same_trimmed
from ledgerline.operators.joins import join_aggregate

# Payment types flagged per order, and the labelled bins of the source.
PAYMENT_FLAGS = ("boleto", "credit_card", "debit_card", "voucher")
LEAD_BIN_EDGES = [0, 3, 10, 20, 50, float("inf")]
LEAD_BIN_LABELS = ["0-3", "4-10", "11-20", "21-50", ">50"]
PRICE_BIN_EDGES = [0, 100, 200, 500, float("inf")]
PRICE_BIN_LABELS = ["0-100", "101-200", "201-500", ">500"]
VOLUME_LIMITS = [(5000, "Small"), (20000, "Medium"), (50000, "Large")]
VOLUME_TOP = "Extra Large"
REVIEW_CLASS_NAMES = {0: "Bad", 1: "Neutral", 2: "Good"}

LEAD_COLUMNS = (
    "days_purchase_to_approved",
    "days_approved_to_carrier",
    "days_carrier_to_customer",
    "days_customer_to_estimated",
    "delivery_minus_purchase",
)


def payment_features(payments: DataFrame) -> DataFrame:
    """Per order: number of payment methods (max sequence), total value, total
    instalments (a sum), and a 0/1 flag per payment type (EC6)."""
    return payments.groupBy("order_id").agg(
        F.max("payment_sequential").alias("total_payments_method"),
        F.sum("payment_value").alias("total_payment_value"),
        F.sum("payment_installments").alias("num_of_installments"),
        *[F.max(flag("payment_type", t)).alias(f"is_{t}") for t in PAYMENT_FLAGS],
    )


def with_lead_times(orders: DataFrame) -> DataFrame:
    """Five whole-day lead times after truncating every timestamp to midnight."""
    return orders.withColumns(
        {
            "days_purchase_to_approved": lead_days("order_approved_at", "order_purchase_timestamp"),
            "days_approved_to_carrier": lead_days("order_delivered_carrier_date", "order_approved_at"),
            "days_carrier_to_customer": lead_days("order_delivered_customer_date", "order_delivered_carrier_date"),
            "days_customer_to_estimated": lead_days("order_estimated_delivery_date", "order_delivered_customer_date"),
            "delivery_minus_purchase": lead_days("order_delivered_customer_date", "order_purchase_timestamp"),
        }
    )


def date_order_rules() -> dict[str, Column]:
    """The three date-order checks of the source."""
    d = {c: F.to_date(c) for c in (
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date")}
    return {
        "approved_after_carrier": d["order_approved_at"] > d["order_delivered_carrier_date"],
        "carrier_after_customer": d["order_delivered_carrier_date"] > d["order_delivered_customer_date"],
        "customer_after_estimate": (d["order_delivered_customer_date"] > d["order_estimated_delivery_date"])
        & (F.col("order_status") == "delivered"),
    }


def clean_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders whose first three lead times are all >= 0 (NULL drops) (EC9)."""
    o = with_lead_times(orders)
    cond = F.col("order_status") == "delivered"
    for c in LEAD_COLUMNS[:3]:
        cond = cond & (F.col(c) >= 0)
    return o.filter(cond)


def item_aggregate(items: DataFrame, dedupe_sellers: bool = False, orders_known: bool = False) -> DataFrame:
    """Items per (order, product): count and summed price, joined back to the items for
    the seller (J10).  As written, a product bought n times in one order comes back n
    times; ``dedupe_sellers`` keeps one row per (order, product, seller).  An item without
    order or product has no seller to join, so such a group comes back once.

    Items are dealt once, by order, and aggregate, join and what joins by order afterwards
    need no other exchange or sort; only items without an order are summed up apart
    (``orders_known``: there are none)."""
    keys = ["order_id", "product_id"]
    sums = [F.count("order_item_id").alias("number_of_items"), F.sum("price").alias("price")]
    if dedupe_sellers:
        right = items.select(*keys, "seller_id").dropDuplicates()
        return items.groupBy(*keys).agg(*sums).join(right, keys, "left")
    place = W.partitionBy(*keys).orderBy("order_item_id")
    group = place.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # the same sort, hence one window
    ordered = items.filter(F.col("order_id").isNotNull()).select(*keys, "order_item_id", "price", "seller_id").repartition("order_id")
    ordered = ordered.select(
        *keys,
        F.count("order_item_id").over(group).alias("number_of_items"),
        F.sum("price").over(group).alias("price"),
        F.when(F.col("product_id").isNotNull(), F.col("seller_id")).alias("seller_id"),
        F.row_number().over(place).alias("_r"),
    )
    ordered = ordered.filter(F.col("product_id").isNotNull() | (F.col("_r") == 1)).drop("_r")
    if orders_known:
        return ordered
    rest = items.filter(F.col("order_id").isNull()).groupBy(*keys).agg(*sums)
    return ordered.unionByName(rest.withColumn("seller_id", F.lit(None).cast(items.schema["seller_id"].dataType)))


def clean_products(products: DataFrame, translation: DataFrame, fill_rules: dict[str, str] | None = None) -> DataFrame:
    """Drop the name length, drop rows with any NULL, add ``volume_cm3``, translate the
    category with the fill rules for untranslated names (F7, P11, J5, P10)."""
    p = products.drop("product_name_lenght").na.drop(how="any")
    p = p.withColumn(
        "volume_cm3", F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    )
    j = join_aggregate(p, translation, "product_category_name", "left")
    english = F.col("product_category_name_english")
    if fill_rules is None:  # default rule: an untranslated name stands for itself
        english = F.coalesce(english, F.col("product_category_name"))
    else:
        for src, dst in fill_rules.items():
            english = F.when(english.isNull() & (F.col("product_category_name") == src), F.lit(dst)).otherwise(
                english
            )
    return j.withColumn("product_category_name_english", english).drop(
        "product_category_name", "product_length_cm", "product_height_cm", "product_width_cm"
    )


def review_category(score: str | Column = "review_score") -> Column:
    """<= 2 -> 0 (bad), 3 -> 1 (neutral), above -> 2 (good); NULL stays NULL (EC14)."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s <= 2, 0).when(s == 3, 1).when(s.isNotNull(), 2)


def review_class_name(c: str | Column) -> Column:
    s = F.col(c) if isinstance(c, str) else c
    return F.when(s == 0, "Bad").when(s == 1, "Neutral").when(s.isNotNull(), "Good")


def model_table(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    items: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    reviews: DataFrame,
    sellers: DataFrame,
) -> DataFrame:
    """The modelling table of the source's six-table star join (EC13).

    reviews INNER clean orders, LEFT payment features, LEFT items per product, LEFT products,
    LEFT customers, LEFT sellers; then ``state_is_equal``.  Joining everything keyed by
    ``order_id`` first lets Spark shuffle each input once, and only the items of clean
    orders are shuffled again, to their products, customers and sellers.
    """
    o = clean_orders(orders)
    pay = payment_features(payments)
    prod = clean_products(products, translation)
    it = item_aggregate(items.filter(F.col("order_id").isNotNull()), orders_known=True)  # others join no order
    base = (
        reviews.select("review_id", "order_id", "review_score")
        .join(o.select("order_id", "customer_id", *LEAD_COLUMNS), "order_id", "inner")
        .join(pay, "order_id", "left")
        .join(it, "order_id", "left")
        .join(prod, "product_id", "left")
    )
    full = base.join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id", "left")
    full = full.join(sellers.select("seller_id", "seller_state"), "seller_id", "left")
    full = full.withColumn("state_is_equal", same_trimmed("customer_state", "seller_state"))
    return full.select(
        "review_id",
        "order_id",
        "review_score",
        "customer_id",
        *LEAD_COLUMNS,
        "customer_unique_id",
        "total_payments_method",
        "total_payment_value",
        "number_of_items",
        "price",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "volume_cm3",
        "product_category_name_english",
        "state_is_equal",
        "num_of_installments",
        *[f"is_{t}" for t in PAYMENT_FLAGS],
        "seller_id",
    )


def volume_class(v: str | Column) -> Column:
    """<= 5000 Small, <= 20000 Medium, <= 50000 Large, else Extra Large (NULL -> Extra
    Large, as the source's if-chain falls through) (P8)."""
    x = F.col(v) if isinstance(v, str) else v
    out = F.lit(VOLUME_TOP)
    for limit, name in reversed(VOLUME_LIMITS):
        out = F.when(x <= limit, name).otherwise(out)
    return out


def lead_bin(c: str) -> Column:
    return bin_left_closed(c, LEAD_BIN_EDGES, LEAD_BIN_LABELS)


def price_bin(c: str) -> Column:
    return bin_right_closed(c, PRICE_BIN_EDGES, PRICE_BIN_LABELS)
