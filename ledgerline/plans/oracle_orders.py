"""DuckDB oracle SQL for the e-commerce queries (EC1-EC23)."""

from __future__ import annotations

from ledgerline.plans.oracle import _with, rhu_double

EC = """
ec_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
         CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'invoiced' END
           AS order_status,
         o.o_orderdate + to_hours(o.o_orderkey % 24) AS order_purchase_timestamp,
         o.o_orderdate + to_hours(o.o_orderkey % 24 + o.o_custkey % 48) AS order_approved_at,
         s.first_ship + INTERVAL 6 HOUR AS order_delivered_carrier_date,
         CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship + INTERVAL 30 HOUR END AS order_delivered_customer_date,
         o.o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
             FROM lineitem GROUP BY 1) s ON o.o_orderkey = s.l_orderkey
),
ec_orders_lt AS (
  SELECT *,
    CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_approved_at AS DATE)) AS INTEGER) AS days_purchase_to_approved,
    CAST(date_diff('day', CAST(order_approved_at AS DATE), CAST(order_delivered_carrier_date AS DATE)) AS INTEGER) AS days_approved_to_carrier,
    CAST(date_diff('day', CAST(order_delivered_carrier_date AS DATE), CAST(order_delivered_customer_date AS DATE)) AS INTEGER)
      AS days_carrier_to_customer,
    CAST(date_diff('day', CAST(order_delivered_customer_date AS DATE), CAST(order_estimated_delivery_date AS DATE)) AS INTEGER)
      AS days_customer_to_estimated,
    CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE)) AS INTEGER)
      AS delivery_minus_purchase
  FROM ec_orders
),
ec_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
         CASE WHEN l_returnflag = 'A' THEN 'credit_card' WHEN l_returnflag = 'N' THEN 'boleto'
              WHEN l_linestatus = 'O' THEN 'voucher' ELSE 'debit_card' END AS payment_type,
         CAST(l_quantity AS INTEGER) % 10 AS payment_installments,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value
  FROM lineitem
),
ec_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem
),
ec_products AS (
  SELECT p_partkey AS product_id, lower(p_type) || '_' || split_part(p_name, ' ', 2) AS product_category_name,
         CAST(length(p_name) AS INTEGER) AS product_name_lenght,
         CASE WHEN p_size % 10 <> 0 THEN p_size * 20 END AS product_description_lenght,
         p_size % 5 + 1 AS product_photos_qty, p_size * 100 AS product_weight_g, p_size AS product_length_cm,
         p_size % 7 + 1 AS product_height_cm, p_size % 11 + 1 AS product_width_cm
  FROM part
),
ec_translation AS (
  SELECT DISTINCT product_category_name, replace(product_category_name, '_', ' ') AS product_category_name_english
  FROM ec_products WHERE NOT starts_with(product_category_name, 'promo')
),
ec_products_clean AS (
  SELECT p.product_id, p.product_description_lenght, p.product_photos_qty, p.product_weight_g,
         p.product_length_cm * p.product_height_cm * p.product_width_cm AS volume_cm3,
         coalesce(t.product_category_name_english, p.product_category_name) AS product_category_name_english
  FROM ec_products p LEFT JOIN ec_translation t USING (product_category_name)
  WHERE p.product_id IS NOT NULL AND p.product_category_name IS NOT NULL AND p.product_description_lenght IS NOT NULL
    AND p.product_photos_qty IS NOT NULL AND p.product_weight_g IS NOT NULL AND p.product_length_cm IS NOT NULL
    AND p.product_height_cm IS NOT NULL AND p.product_width_cm IS NOT NULL
),
ec_sellers AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, s_name AS seller_city, n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
ec_customers AS (
  SELECT c_custkey AS customer_id, 'u' || CAST(c_custkey // 2 AS VARCHAR) AS customer_unique_id,
         c_nationkey AS customer_zip_code_prefix, c_name AS customer_city, n_name || ' ' AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
ec_reviews AS (
  SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS review_id, o_orderkey AS order_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
  FROM orders
),
ec_clean_orders AS (
  SELECT * FROM ec_orders_lt
  WHERE order_status = 'delivered' AND days_purchase_to_approved >= 0 AND days_approved_to_carrier >= 0
    AND days_carrier_to_customer >= 0
),
ec_pay_features AS (
  SELECT order_id, max(payment_sequential) AS total_payments_method, sum(payment_value) AS total_payment_value,
         CAST(sum(payment_installments) AS BIGINT) AS num_of_installments,
         max(CASE WHEN payment_type = 'boleto' THEN 1 ELSE 0 END) AS is_boleto,
         max(CASE WHEN payment_type = 'credit_card' THEN 1 ELSE 0 END) AS is_credit_card,
         max(CASE WHEN payment_type = 'debit_card' THEN 1 ELSE 0 END) AS is_debit_card,
         max(CASE WHEN payment_type = 'voucher' THEN 1 ELSE 0 END) AS is_voucher
  FROM ec_payments GROUP BY 1
),
ec_item_agg AS (
  SELECT a.order_id, a.product_id, a.number_of_items, a.price, i.seller_id
  FROM (SELECT order_id, product_id, count(order_item_id) AS number_of_items, sum(price) AS price
        FROM ec_items GROUP BY 1, 2) a
  LEFT JOIN (SELECT order_id, product_id, seller_id FROM ec_items) i USING (order_id, product_id)
),
ec_model AS (
  SELECT r.review_id, r.order_id, r.review_score, co.customer_id,
         co.days_purchase_to_approved, co.days_approved_to_carrier, co.days_carrier_to_customer,
         co.days_customer_to_estimated, co.delivery_minus_purchase,
         c.customer_unique_id, pf.total_payments_method, pf.total_payment_value,
         ia.number_of_items, ia.price, pc.product_description_lenght, pc.product_photos_qty, pc.product_weight_g,
         pc.volume_cm3, pc.product_category_name_english,
         CASE WHEN trim(c.customer_state) = trim(s.seller_state) THEN '1' ELSE '0' END AS state_is_equal,
         pf.num_of_installments, pf.is_boleto, pf.is_credit_card, pf.is_debit_card, pf.is_voucher, ia.seller_id,
         CASE WHEN r.review_score <= 2 THEN 0 WHEN r.review_score = 3 THEN 1
              WHEN r.review_score IS NOT NULL THEN 2 END AS review_category
  FROM ec_reviews r
  JOIN ec_clean_orders co ON r.order_id = co.order_id
  LEFT JOIN ec_pay_features pf ON r.order_id = pf.order_id
  LEFT JOIN ec_item_agg ia ON r.order_id = ia.order_id
  LEFT JOIN ec_products_clean pc ON ia.product_id = pc.product_id
  LEFT JOIN ec_customers c ON co.customer_id = c.customer_id
  LEFT JOIN ec_sellers s ON ia.seller_id = s.seller_id
)
"""

PAY_COLS = ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]
PROD_COLS = ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
             "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


def _profile(table: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_non_null, "
        f"count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_nulls FROM {table}"
        for c in cols
    ]
    return _with(EC) + "\nUNION ALL\n".join(parts)


def _describe_cols(table: str, cols: list[str], by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT {key}'{c}' AS column_name, count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
            f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
            f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM {table}{grp}"
        )
    return "\nUNION ALL\n".join(parts)


def _box(value: str, by: str, where: str = "") -> str:
    return f"""
, src AS (SELECT {by} AS g, CAST({value} AS DOUBLE) AS x FROM ec_model_ext {where})
, q AS (SELECT g, count(x) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
               quantile_cont(x, 0.75) AS q3 FROM src GROUP BY g)
, f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
, e AS (SELECT f.g,
               min(CASE WHEN x BETWEEN lower_fence AND upper_fence THEN x END) AS whisker_low,
               max(CASE WHEN x BETWEEN lower_fence AND upper_fence THEN x END) AS whisker_high,
               count(CASE WHEN NOT (x BETWEEN lower_fence AND upper_fence) THEN 1 END) AS n_outliers
        FROM src JOIN f USING (g) WHERE x IS NOT NULL GROUP BY f.g)
SELECT f.g AS {by}, n, q1, median, q3, lower_fence, upper_fence, whisker_low, whisker_high, n_outliers
FROM f LEFT JOIN e USING (g)
"""


MODEL_EXT = """
ec_model_ext AS (
  SELECT *,
    CASE WHEN volume_cm3 <= 5000 THEN 'Small' WHEN volume_cm3 <= 20000 THEN 'Medium'
         WHEN volume_cm3 <= 50000 THEN 'Large' ELSE 'Extra Large' END AS volume_category,
    CASE WHEN price > 0 AND price <= 100 THEN '0-100' WHEN price > 100 AND price <= 200 THEN '101-200'
         WHEN price > 200 AND price <= 500 THEN '201-500' WHEN price > 500 THEN '>500' END AS price_bin,
    CASE WHEN review_category = 0 THEN 'Bad' WHEN review_category = 1 THEN 'Neutral'
         WHEN review_category IS NOT NULL THEN 'Good' END AS review_class
  FROM ec_model
)
"""


def _lead_bin(c: str) -> str:
    return (f"CASE WHEN {c} >= 0 AND {c} < 3 THEN '0-3' WHEN {c} >= 3 AND {c} < 10 THEN '4-10' "
            f"WHEN {c} >= 10 AND {c} < 20 THEN '11-20' WHEN {c} >= 20 AND {c} < 50 THEN '21-50' "
            f"WHEN {c} >= 50 THEN '>50' END")


LEADS = ["days_purchase_to_approved", "days_approved_to_carrier", "days_carrier_to_customer",
         "days_customer_to_estimated", "delivery_minus_purchase"]

_CAT_SCORES = """
, cs AS (SELECT product_category_name_english, avg(review_score) AS mean_score, count(review_id) AS n_reviews,
                stddev_samp(review_score) AS std_score
         FROM ec_model WHERE product_category_name_english IS NOT NULL GROUP BY 1)
"""

ORDERS_SQL: dict[str, str] = {
    "ec1_profile_payments": _profile("ec_payments", PAY_COLS),
    "ec1_describe_payments": _with(EC) + _describe_cols(
        "ec_payments", ["payment_sequential", "payment_installments", "payment_value"]),
    "ec1_duplicates_payments": _with(EC) + """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates,
       count(CASE WHEN n > 1 THEN 1 END) AS n_repeated_keys
FROM (SELECT count(*) AS n FROM ec_payments
      GROUP BY order_id, payment_sequential, payment_type, payment_installments, payment_value)
""",
    "ec1_profile_products": _profile("ec_products", PROD_COLS),
    "ec1_payment_value_histogram": _with(EC) + """
, r AS (SELECT min(CAST(payment_value AS DOUBLE)) AS lo, max(CAST(payment_value AS DOUBLE)) AS hi FROM ec_payments)
, b AS (SELECT CASE WHEN hi = lo THEN 1
                    ELSE least(CAST(floor((CAST(payment_value AS DOUBLE) - lo) / ((hi - lo) / 20)) AS INTEGER) + 1, 20)
               END AS bin, lo, hi
        FROM ec_payments, r WHERE payment_value IS NOT NULL)
SELECT bin, lo + (bin - 1) * (hi - lo) / 20 AS bin_start, lo + bin * (hi - lo) / 20 AS bin_end, count(*) AS count
FROM b GROUP BY bin, lo, hi
""",
    "ec2_payment_count_distribution": _with(EC) + f"""
, po AS (SELECT order_id, count(DISTINCT payment_sequential) AS payment_count, sum(payment_value) AS v
         FROM ec_payments WHERE payment_type IS DISTINCT FROM 'not_defined' GROUP BY 1)
, g AS (SELECT payment_count, count(*) AS order_count, sum(v) AS v FROM po GROUP BY 1)
, t AS (SELECT sum(order_count) AS orders FROM g)
SELECT payment_count, order_count, CAST(v AS DOUBLE) AS total_payment_value,
       {rhu_double('order_count', 'orders', 4, 100, 0)} AS pct_orders
FROM g, t ORDER BY 1
""",
    "ec3_payment_type_by_sequence": _with(EC) + """
SELECT payment_sequential, payment_type, count(payment_value) AS n_payments FROM ec_payments
WHERE payment_type IS DISTINCT FROM 'not_defined' AND payment_sequential IN (1, 2) GROUP BY 1, 2
""",
    "ec4_installment_distribution": _with(EC) + """
SELECT payment_installments, count(*) AS n_payments FROM ec_payments
WHERE payment_type IS DISTINCT FROM 'not_defined' AND payment_installments IS DISTINCT FROM 0 GROUP BY 1 ORDER BY 1
""",
    "ec5_payment_totals_by_type": _with(EC) + """
, p AS (SELECT * FROM ec_payments WHERE payment_type IS DISTINCT FROM 'not_defined')
, tot AS (SELECT payment_type, CAST(sum(payment_value) AS DOUBLE) AS total_payment_value FROM p GROUP BY 1)
, d AS (""" + _describe_cols("p", ["payment_value"], by="payment_type") + """)
SELECT tot.payment_type, total_payment_value, count, mean, std, min, p25, p50, p75, max
FROM tot JOIN d USING (payment_type)
""",
    "ec5_order_value_describe": _with(EC) + """
, p AS (SELECT order_id, sum(payment_value) AS order_value FROM ec_payments
        WHERE payment_type IS DISTINCT FROM 'not_defined' GROUP BY 1)
, d AS (""" + _describe_cols("p", ["order_value"]) + """)
SELECT d.*, (SELECT CAST(sum(order_value) AS DOUBLE) FROM p) AS grand_total FROM d
""",
    "ec5_describe_by_type_and_installments": _with(EC) + """
, p AS (SELECT * FROM ec_payments WHERE payment_type IS DISTINCT FROM 'not_defined')
, d AS (""" + _describe_cols("p", ["payment_value"], by="payment_type, payment_installments") + """)
SELECT * EXCLUDE (column_name) FROM d
""",
    "ec6_order_payment_features": _with(EC) + """
SELECT order_id, total_payments_method, CAST(total_payment_value AS DOUBLE) AS total_payment_value,
       num_of_installments, is_boleto, is_credit_card, is_debit_card, is_voucher
FROM ec_pay_features
""",
    "ec6_payment_flag_shares": _with(EC) + "SELECT " + ", ".join(
        f"{rhu_double(f'sum(is_{t})', 'count(*)', 4, 100, 0)} AS pct_{t}"
        for t in ("boleto", "credit_card", "debit_card", "voucher")) + " FROM ec_pay_features",
    "ec7_clean_products": _with(EC) + "SELECT * FROM ec_products_clean",
    "ec8_photo_distribution": _with(EC) + """
, g AS (SELECT product_photos_qty, count(*) AS n FROM ec_products_clean WHERE product_photos_qty IS NOT NULL GROUP BY 1)
SELECT product_photos_qty, n AS count, CAST(n AS DOUBLE) * 100.0 / CAST((SELECT sum(n) FROM g) AS DOUBLE) AS percent
FROM g ORDER BY 1
""",
    "ec9_status_counts": _with(EC) + """
SELECT order_status, count(*) AS count FROM ec_orders WHERE order_status IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1
""",
    "ec9_date_violations": _with(EC) + f"""
, r AS (SELECT
   count(*) AS n,
   count(CASE WHEN CAST(order_approved_at AS DATE) > CAST(order_delivered_carrier_date AS DATE) THEN 1 END) AS a,
   count(CASE WHEN CAST(order_delivered_carrier_date AS DATE) > CAST(order_delivered_customer_date AS DATE) THEN 1 END) AS b,
   count(CASE WHEN CAST(order_delivered_customer_date AS DATE) > CAST(order_estimated_delivery_date AS DATE)
               AND order_status = 'delivered' THEN 1 END) AS c
  FROM ec_orders)
SELECT a AS n_approved_after_carrier, b AS n_carrier_after_customer, c AS n_customer_after_estimate,
       {rhu_double('a', 'n', 4, 100, 0)} AS pct_approved_after_carrier,
       {rhu_double('b', 'n', 4, 100, 0)} AS pct_carrier_after_customer,
       {rhu_double('c', 'n', 4, 100, 0)} AS pct_customer_after_estimate
FROM r
""",
    "ec9_clean_orders": _with(EC) + "SELECT order_id, customer_id, " + ", ".join(LEADS) + " FROM ec_clean_orders",
    "ec9_negative_lead_times": _with(EC) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(CASE WHEN {c} < 0 THEN 1 END) AS n_negative, "
        f"count(CASE WHEN {c} < 0 THEN 1 END) > 0 AS has_negative FROM ec_orders_lt" for c in LEADS),
    "ec10_item_aggregate": _with(EC) + """
SELECT order_id, product_id, number_of_items, CAST(price AS DOUBLE) AS price, seller_id FROM ec_item_agg
""",
    "ec11_customer_counts": _with(EC) + f"""
, per AS (SELECT customer_unique_id, count(*) AS n FROM ec_customers GROUP BY 1)
, r AS (SELECT count(*) AS n_unique_customers, CAST(sum(n) AS BIGINT) AS n_purchases,
               count(CASE WHEN n > 1 THEN 1 END) AS n_repeat_customers FROM per)
, g AS (SELECT count(DISTINCT customer_city) AS n_cities, count(DISTINCT customer_state) AS n_states FROM ec_customers)
SELECT n_unique_customers, n_purchases, n_repeat_customers, n_cities, n_states,
       {rhu_double('n_repeat_customers', 'n_unique_customers', 4, 100, 0)} AS repeat_customer_pct
FROM r, g
""",
    "ec12_sellers_per_state": _with(EC) + "SELECT seller_state, count(*) AS n_sellers FROM ec_sellers GROUP BY 1",
    "ec13_model_table": _with(EC) + """
SELECT * REPLACE (CAST(total_payment_value AS DOUBLE) AS total_payment_value, CAST(price AS DOUBLE) AS price)
FROM ec_model
""",
    "ec14_review_categories": _with(EC) + "SELECT review_category, count(*) AS n_reviews FROM ec_model GROUP BY 1",
    "ec15_payment_by_score": _with(EC) + f"""
, g AS (SELECT review_score, sum(total_payment_value) AS v FROM ec_model GROUP BY 1)
, t AS (SELECT sum(v) AS total, sum(CASE WHEN review_score >= 4 THEN v END) AS good FROM g)
SELECT review_score, CAST(v AS DOUBLE) AS total_payment_value,
       {rhu_double('v', 'total', 4, 100)} AS pct_of_value,
       {rhu_double('good', 'total', 4, 100)} AS pct_value_in_4_5
FROM g, t
""",
    "ec16_category_review_pivot_top10": _with(EC) + """
SELECT product_category_name_english,
       count(CASE WHEN review_category = 0 THEN 1 END) AS n_bad,
       count(CASE WHEN review_category = 1 THEN 1 END) AS n_neutral,
       count(CASE WHEN review_category = 2 THEN 1 END) AS n_good,
       count(CASE WHEN review_category IN (0, 1, 2) THEN 1 END) AS total_reviews
FROM ec_model WHERE review_score IS NOT NULL AND product_category_name_english IS NOT NULL
GROUP BY 1 ORDER BY total_reviews DESC, 1 LIMIT 10
""",
    "ec17_category_scores": _with(EC) + _CAT_SCORES + "SELECT * FROM cs",
    "ec17_top10_by_count": _with(EC) + _CAT_SCORES + "SELECT * FROM cs ORDER BY n_reviews DESC, 1 LIMIT 10",
    "ec17_bottom10_by_mean": _with(EC) + _CAT_SCORES + "SELECT * FROM cs ORDER BY mean_score ASC, 1 LIMIT 10",
    "ec17_top5_std_share": _with(EC) + _CAT_SCORES + f"""
, t AS (SELECT count(*) AS a FROM ec_model)
SELECT product_category_name_english, std_score, n_reviews, {rhu_double('n_reviews', 'a', 4, 100, 0)} AS pct_of_orders
FROM cs, t ORDER BY std_score DESC NULLS LAST, 1 LIMIT 5
""",
    "ec18_lead_by_score": _with(EC) + """
SELECT review_score, avg(delivery_minus_purchase) AS mean_delivery_days FROM ec_model GROUP BY 1
""",
    "ec18_lead_by_category_top10": _with(EC) + """
SELECT product_category_name_english, avg(delivery_minus_purchase) AS mean_delivery_days, count(review_id) AS n_reviews
FROM ec_model WHERE product_category_name_english IS NOT NULL GROUP BY 1
ORDER BY mean_delivery_days DESC NULLS LAST, n_reviews DESC, 1 LIMIT 10
""",
    "ec19_payment_price_by_class": _with(EC, MODEL_EXT) + """
SELECT review_class, CAST(sum(total_payment_value) AS DOUBLE) / count(total_payment_value) AS mean_payment_value,
       CAST(sum(price) AS DOUBLE) / count(price) AS mean_price
FROM ec_model_ext GROUP BY 1
""",
    "ec19_score_by_same_state": _with(EC) + "SELECT state_is_equal, avg(review_score) AS mean_score FROM ec_model GROUP BY 1",
    "ec20_customers_sellers_by_score": _with(EC) + """
SELECT review_score, count(customer_id) AS n_customers, count(seller_id) AS n_sellers FROM ec_model GROUP BY 1
""",
    "ec20_share_in_top_scores": _with(EC) + f"""
, s AS (SELECT count(CASE WHEN review_score >= 4 THEN customer_id END) AS c, count(customer_id) AS nc,
               count(CASE WHEN review_score >= 4 THEN seller_id END) AS s, count(seller_id) AS ns FROM ec_model)
SELECT {rhu_double('c', 'nc', 4, 100, 0)} AS pct_customers, {rhu_double('s', 'ns', 4, 100, 0)} AS pct_sellers FROM s
""",
    "ec21_neutral_vs_positive_leads": _with(EC, MODEL_EXT) + "SELECT review_class, " + ", ".join(
        f"avg({c}) AS mean_{c}" for c in LEADS) + " FROM ec_model_ext WHERE review_category IN (1, 2) GROUP BY 1",
    "ec22_score_by_lead_bin": _with(EC) + "\n, s AS (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS lead_measure, {_lead_bin(c)} AS lead_bin, review_score FROM ec_model"
        for c in ["days_purchase_to_approved", "days_approved_to_carrier", "days_carrier_to_customer",
                  "delivery_minus_purchase"]) + """)
SELECT lead_measure, lead_bin, avg(review_score) AS mean_score, count(*) AS n_reviews
FROM s WHERE lead_bin IS NOT NULL GROUP BY 1, 2
""",
    "ec23_score_box_by_volume": _with(EC, MODEL_EXT) + _box("review_score", "volume_category"),
    "ec23_score_box_by_price_bin": _with(EC, MODEL_EXT) + _box("review_score", "price_bin",
                                                               "WHERE price_bin IS NOT NULL"),
}
