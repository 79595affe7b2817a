"""Reference-shaped inputs derived from the driver's test tables.

Each builder reads whole test tables and returns a lazy DataFrame with the columns
the reference's input had (see FIXTURES.md).  The mapping is fixed so the DuckDB
oracle in ``plans.oracle`` can state the same derivation independently.

weekly_sales      orders x customer x nation x region, aggregated to week grain
web_events        events (cookie = user_id, visit = user x day, page = props.k)
trips             lineitem x orders (start = order date + hour, end = ship date)
order tables      payments / items / products / sellers / customers / reviews from
                  the TPC-H-ish tables
claims            customer x lineitem numerics, for the multivariate statistics
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import add_calendar, derive_segment, parse_dmy_2digit
from ledgerline.sources.tables import load_table

# Fixed values used by the stand-in mappings (our choice, documented in FIXTURES.md).
PLATFORM_BY_PRIORITY = {  # o_orderpriority -> platform
    "1-URGENT": "Retail",
    "2-HIGH": "Retail",
    "3-MEDIUM": "Retail",
    "4-NOT SPECIFIED": "Shopify",
    "5-LOW": "Shopify",
}
CUSTOMER_TYPE_BY_STATUS = {"F": "Existing", "O": "New", "P": "Guest"}
SEGMENT_LETTER_BY_MKT = {"AUTOMOBILE": "C", "BUILDING": "F", "FURNITURE": "C", "HOUSEHOLD": "F"}


def _case(col: str, mapping: dict, default=None):
    out = F.lit(default)
    for k, v in reversed(list(mapping.items())):
        out = F.when(F.col(col) == k, F.lit(v)).otherwise(out)
    return out


# --------------------------------------------------------------------------- weekly sales

def weekly_sales(spark: SparkSession, sf_dir: str, years: tuple[int, ...] | None = None) -> DataFrame:
    """Raw weekly-sales table: ``week_date`` text ``d/M/yy`` (Monday of the ISO week),
    region, platform, segment code, customer_type, transactions, sales decimal(18,2).

    ``years``: only weeks whose Monday falls in one of these calendar years are needed.
    Such a week holds orders dated from Jan 1 of the year up to Jan 6 of the next, so
    that order-date range is filtered before the join and aggregation; it reaches the
    parquet scan as a pushed filter.  The exact year filter is still applied by the
    caller on ``calendar_year``."""
    o = load_table(spark, sf_dir, "orders")
    if years:
        lo, hi = min(years), max(years)
        o = o.filter(
            (F.col("o_orderdate") >= F.lit(f"{lo}-01-01").cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(f"{hi + 1}-01-07").cast("timestamp_ntz"))
        )
    c = load_table(spark, sf_dir, "customer")
    n = load_table(spark, sf_dir, "nation")
    r = load_table(spark, sf_dir, "region")
    letter = _case("c_mktsegment", SEGMENT_LETTER_BY_MKT)
    segment = F.when(letter.isNull(), F.lit("null")).otherwise(
        F.concat(letter, (F.col("c_custkey") % 4 + 1).cast("string"))
    )
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    rows = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.date_trunc("week", "o_orderdate").cast("date").alias("_week"),
            F.col("r_name").alias("region"),
            _case("o_orderpriority", PLATFORM_BY_PRIORITY).alias("platform"),
            segment.alias("segment"),
            _case("o_orderstatus", CUSTOMER_TYPE_BY_STATUS).alias("customer_type"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("_price"),
        )
    )
    return (
        rows.groupBy("_week", "region", "platform", "segment", "customer_type")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("_price").cast("decimal(18,2)").alias("sales"),
        )
        .select(
            F.date_format("_week", "d/M/yy").alias("week_date"),
            "region",
            "platform",
            "segment",
            "customer_type",
            "transactions",
            "sales",
        )
    )


def clean_weekly_sales(raw: DataFrame) -> DataFrame:
    """The cleaned weekly-sales table (DM1): parsed date, calendar parts, segment codes,
    and ``avg_transactions = round(sales / transactions, 2)`` (NULL when no transactions)."""
    df = raw.withColumn("clean_week_date", parse_dmy_2digit("week_date"))
    df = add_calendar(df, "clean_week_date")
    df = derive_segment(df, "segment")
    cents = (F.col("sales") * 100).cast("decimal(20,0)")
    t = F.col("transactions").cast("decimal(20,0)")
    avg = F.round(F.when(t != 0, cents / t), 0) / 100
    return df.select(
        "clean_week_date",
        "week_number",
        "month_number",
        "calendar_year",
        "region",
        "platform",
        "segment",
        "clean_segment_number",
        "demographic_segment",
        "age_band",
        "customer_type",
        "transactions",
        "sales",
        avg.cast("double").alias("avg_transactions"),
    )


def clean_sales(spark: SparkSession, sf_dir: str, years: tuple[int, ...] | None = None) -> DataFrame:
    """Cleaned weekly sales; with ``years`` only those calendar years (read pruned)."""
    clean = clean_weekly_sales(weekly_sales(spark, sf_dir, years))
    return clean.filter(F.col("calendar_year").isin(list(years))) if years else clean


# --------------------------------------------------------------------------- web events

# The event and page lookups of the web-shop case, and campaigns placed
# inside the test data's month (two of them overlap on purpose).
EVENT_TYPE_BY_KIND = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
EVENT_NAMES = [
    (1, "Page View"),
    (2, "Add to Cart"),
    (3, "Purchase"),
    (4, "Ad Impression"),
    (5, "Ad Click"),
]
PAGES = [
    (1, "Home Page", None, None),
    (2, "All Products", None, None),
    (3, "Salmon", "Fish", 1),
    (4, "Kingfish", "Fish", 2),
    (5, "Tuna", "Fish", 3),
    (6, "Russian Caviar", "Luxury", 4),
    (7, "Black Truffle", "Luxury", 5),
    (8, "Abalone", "Shellfish", 6),
    (9, "Lobster", "Shellfish", 7),
    (10, "Crab", "Shellfish", 8),
    (11, "Oyster", "Shellfish", 9),
    (12, "Checkout", None, None),
    (13, "Confirmation", None, None),
]
CAMPAIGNS = [
    ("BOGOF - Fishing For Compliments", "2024-01-01", "2024-01-10"),
    ("25% Off - Living The Lux Life", "2024-01-08", "2024-01-15"),
    ("Half Off - Treat Your Shellf(ish)", "2024-01-20", "2024-01-31"),
]


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event table: event_id, cookie_id, visit_id (cookie x day), page_id (1-13 from
    ``props.k``), event_type (1-5), event_time."""
    e = load_table(spark, sf_dir, "events")
    cookie = F.concat(F.lit("c"), F.col("user_id").cast("string"))
    return e.select(
        "event_id",
        cookie.alias("cookie_id"),
        F.concat(cookie, F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("visit_id"),
        (F.get_json_object("props", "$.k").cast("int") % 13 + 1).alias("page_id"),
        _case("event_type", EVENT_TYPE_BY_KIND).cast("int").alias("event_type"),
        F.col("ts").alias("event_time"),
    )


def web_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and their cookies: two cookies per user (user = source user_id div 2)."""
    e = load_table(spark, sf_dir, "events")
    return e.select(
        F.expr("user_id div 2").alias("user_id"),
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("cookie_id"),
    ).distinct()


def event_names(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(EVENT_NAMES, "event_type int, event_name string"))


def page_hierarchy(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(PAGES, "page_id int, page_name string, product_category string, product_id int"))


def campaigns(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(CAMPAIGNS, "campaign_name string, start_date string, end_date string")
    return F.broadcast(df.select("campaign_name", F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date")))


# --------------------------------------------------------------------------- trips

# Rider type by line status, bike type by return flag.
RIDER_BY_LINESTATUS = {"O": "member", "F": "casual"}
BIKE_BY_RETURNFLAG = {"A": "classic_bike", "N": "docked_bike", "R": "electric_bike"}


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip rows: start = order date + (quantity mod 24) hours, end = ship date; about
    half end before they start, which the cleaning step removes."""
    li = load_table(spark, sf_dir, "lineitem")
    o = load_table(spark, sf_dir, "orders")
    j = li.join(o.select("o_orderkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
    return j.select(
        F.timestamp_add("HOUR", F.col("l_quantity").cast("int") % 24, F.col("o_orderdate")).alias("started_at"),
        F.col("l_shipdate").alias("ended_at"),
        _case("l_linestatus", RIDER_BY_LINESTATUS).alias("member_casual"),
        _case("l_returnflag", BIKE_BY_RETURNFLAG).alias("rideable_type"),
        F.concat(F.lit("Station "), F.col("l_suppkey").cast("string")).alias("start_station_name"),
        F.concat(F.lit("Dock "), (F.col("l_partkey") % 50).cast("string")).alias("end_station_name"),
    )


# --------------------------------------------------------------------------- e-commerce

# Order status by TPC-H status code.
ORDER_STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "invoiced"}


def ec_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the five timestamps: purchase (order date + key mod 24 h), approval
    (purchase + customer mod 48 h), carrier (first ship date + 6 h), customer delivery
    (last ship date + 30 h, delivered orders only), estimate (order date + 30 days)."""
    o = load_table(spark, sf_dir, "orders")
    li = load_table(spark, sf_dir, "lineitem")
    ship = li.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("_first_ship"), F.max("l_shipdate").alias("_last_ship")
    )
    j = o.join(ship, o.o_orderkey == ship.l_orderkey, "left")
    status = _case("o_orderstatus", ORDER_STATUS_BY_CODE)
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.timestamp_add("HOUR", F.col("o_orderkey") % 24, F.col("o_orderdate")).alias("order_purchase_timestamp"),
        F.timestamp_add("HOUR", F.col("o_orderkey") % 24 + F.col("o_custkey") % 48, F.col("o_orderdate")).alias(
            "order_approved_at"
        ),
        F.timestamp_add("HOUR", F.lit(6), F.col("_first_ship")).alias("order_delivered_carrier_date"),
        F.when(status == "delivered", F.timestamp_add("HOUR", F.lit(30), F.col("_last_ship"))).alias(
            "order_delivered_customer_date"
        ),
        F.timestamp_add("DAY", F.lit(30), F.col("o_orderdate")).alias("order_estimated_delivery_date"),
    )


def ec_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per line item: sequence = line number; type from return flag and
    line status; instalments = quantity mod 10; value = extended price."""
    li = load_table(spark, sf_dir, "lineitem")
    ptype = (
        F.when(F.col("l_returnflag") == "A", "credit_card")
        .when(F.col("l_returnflag") == "N", "boleto")
        .when(F.col("l_linestatus") == "O", "voucher")
        .otherwise("debit_card")
    )
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        ptype.alias("payment_type"),
        (F.col("l_quantity").cast("int") % 10).alias("payment_installments"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_value"),
    )


def ec_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_tax").alias("freight_value"),
        F.col("l_shipdate").alias("shipping_limit_date"),
    )


def ec_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products: category = part type + noun of the part name; sizes from ``p_size``;
    the description length is missing for every tenth size (exercises ``dropna``)."""
    p = load_table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lower("p_type"), F.lit("_"), F.split_part("p_name", F.lit(" "), F.lit(2))).alias(
            "product_category_name"
        ),
        F.length("p_name").alias("product_name_lenght"),
        F.when(size % 10 != 0, size * 20).alias("product_description_lenght"),
        (size % 5 + 1).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size % 7 + 1).alias("product_height_cm"),
        (size % 11 + 1).alias("product_width_cm"),
    )


def ec_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category -> English name (underscores to spaces); the ``promo_*`` categories are
    missing on purpose, as two categories are in the source's translation file."""
    cats = ec_products(spark, sf_dir).select("product_category_name").distinct()
    return cats.filter(~F.col("product_category_name").startswith("promo")).select(
        "product_category_name",
        F.regexp_replace("product_category_name", "_", " ").alias("product_category_name_english"),
    )


def ec_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load_table(spark, sf_dir, "supplier")
    n = load_table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def ec_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; two customer ids share one ``customer_unique_id`` (repeat buyers)."""
    c = load_table(spark, sf_dir, "customer")
    n = load_table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("u"), F.expr("c_custkey div 2").cast("string")).alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_name").alias("customer_city"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("customer_state"),  # trailing blank, trimmed later
    )


def ec_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order; score = the digit of the order priority (1-5)."""
    o = load_table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
        F.timestamp_add("DAY", F.lit(40), F.col("o_orderdate")).alias("review_creation_date"),
    )


# --------------------------------------------------------------------------- claims

# Vehicle origin by return flag.
REGION_BY_RETURNFLAG = {"A": "EUROPE", "N": "EAST ASIA", "R": "LOCAL"}


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim per line item: Female (line status F), Age (18 + customer mod 60),
    Engine_Capacity (50 x quantity), Vehicle_Age (line number), Car_Value (extended
    price), Claim_Amount (order total x (discount + tax), zero for some rows),
    Vehicle_Make_Region, Claim_Amount_Indicator (discount >= 0.05)."""
    li = load_table(spark, sf_dir, "lineitem")
    o = load_table(spark, sf_dir, "orders")
    j = li.join(o.select("o_orderkey", "o_custkey", "o_totalprice"), li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("l_orderkey").alias("claim_order"),
        F.col("l_linenumber").alias("claim_line"),
        F.col("l_partkey").alias("claim_part"),
        (F.col("l_linestatus") == "F").cast("int").alias("Female"),
        (F.lit(18) + F.col("o_custkey") % 60).cast("double").alias("Age"),
        (F.col("l_quantity") * 50).alias("Engine_Capacity"),
        F.col("l_linenumber").cast("double").alias("Vehicle_Age"),
        F.col("l_extendedprice").alias("Car_Value"),
        (F.col("o_totalprice") * (F.col("l_discount") + F.col("l_tax"))).alias("Claim_Amount"),
        _case("l_returnflag", REGION_BY_RETURNFLAG).alias("Vehicle_Make_Region"),
        (F.col("l_discount") >= 0.05).cast("int").alias("Claim_Amount_Indicator"),
    )


def claims_recoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds Foreign (EUROPE / EAST ASIA -> FOREIGN, else as is) and Foreign_factor
    (LOCAL -> 0, else 1) (M26)."""
    c = claims(spark, sf_dir)
    foreign = F.when(F.col("Vehicle_Make_Region").isin("EUROPE", "EAST ASIA"), F.lit("FOREIGN")).otherwise(
        F.col("Vehicle_Make_Region")
    )
    return c.withColumn("Foreign", foreign).withColumn(
        "Foreign_factor", F.when(F.col("Foreign") == "LOCAL", 0).otherwise(1)
    )
