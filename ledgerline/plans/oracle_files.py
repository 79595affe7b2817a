"""DuckDB oracle SQL for written files and tables, split and resampling counts, flags and tail probabilities."""

from __future__ import annotations

from ledgerline.plans.oracle import WEEKLY_SALES, _with
from ledgerline.plans.oracle_orders import EC
from ledgerline.plans.oracle_stats import CLAIMS, EXPERIMENT, NUMERIC, _chi2, _hotelling, _two_sample

LINES = """
lines AS (
  SELECT l.l_orderkey % 50 AS kind, strftime(o.o_orderdate, '%Y-%m') AS file_month,
         o.o_orderdate + to_hours(CAST(l.l_quantity AS INTEGER) % 24) AS started_at, l.l_shipdate AS ended_at,
         l.l_orderkey || '-' || l.l_linenumber AS ride_id, CAST(l.l_quantity AS INTEGER) AS minutes,
         CASE l.l_linestatus WHEN 'O' THEN 'member' WHEN 'F' THEN 'casual' END AS member_casual, l.l_suppkey AS station
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
kept AS (SELECT * FROM lines WHERE kind NOT IN (7, 13, 21))
"""

# --------------------------------------------------------------------------- model rows

MODEL_ROWS = """
ml AS (
  SELECT CAST(review_category AS DOUBLE) AS label FROM ec_model
  WHERE review_category IS NOT NULL AND days_purchase_to_approved IS NOT NULL AND days_approved_to_carrier IS NOT NULL
    AND days_carrier_to_customer IS NOT NULL AND days_customer_to_estimated IS NOT NULL AND delivery_minus_purchase IS NOT NULL
    AND total_payments_method IS NOT NULL AND total_payment_value IS NOT NULL AND number_of_items IS NOT NULL
    AND price IS NOT NULL AND product_description_lenght IS NOT NULL AND product_photos_qty IS NOT NULL
    AND product_weight_g IS NOT NULL AND volume_cm3 IS NOT NULL AND num_of_installments IS NOT NULL
    AND is_boleto IS NOT NULL AND is_credit_card IS NOT NULL AND is_debit_card IS NOT NULL AND is_voucher IS NOT NULL
),
sizes AS (SELECT label, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS n_test FROM ml GROUP BY 1)
"""

# --------------------------------------------------------------------------- tail probabilities

#: Terms of the fractions and series; the far end is where they start.
TERMS = 2000


def _steps(n: int) -> str:
    return f"list_reverse(list_transform(range(1, {n + 1}), lambda m: CAST(m AS DOUBLE)))"


def beta_tail(a: str, b: str, x: str, y: str) -> str:
    """I_x(a, b) as an expression; y = 1 - x."""

    def part(a: str, b: str, x: str, y: str) -> str:
        fraction = (
            f"list_reduce({_steps(TERMS)}, lambda acc, m: 1 - ({a} + m - 1) * ({a} + {b} + m - 1) * {x} / (({a} + 2 * m - 2) * ({a} + 2 * m - 1))"
            f" / (1 + m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m)) / acc), CAST(1 AS DOUBLE))"
        )
        return f"exp({a} * ln({x}) + {b} * ln({y}) + lgamma({a} + {b}) - lgamma({a}) - lgamma({b})) / {fraction} / {a}"

    return f"(CASE WHEN {x} <= 0 THEN 0 WHEN {y} <= 0 THEN 1 WHEN {x} < ({a} + 1) / ({a} + {b} + 2) THEN {part(a, b, x, y)} ELSE 1 - {part(b, a, y, x)} END)"


def gamma_tail(s: str, x: str) -> str:
    """Q(s, x) as an expression."""
    front = f"exp({s} * ln({x}) - {x} - lgamma({s}))"
    series = f"list_reduce({_steps(500)}, lambda acc, m: 1 + {x} / ({s} + m) * acc, CAST(1 AS DOUBLE))"
    fraction = f"list_reduce({_steps(500)}, lambda acc, m: {x} + 2 * m - 1 - {s} - m * (m - {s}) / acc, CAST({x} + 1001 - {s} AS DOUBLE))"
    return f"(CASE WHEN {x} <= 0 THEN 1 WHEN {x} < {s} + 1 THEN 1 - {front} * {series} / {s} ELSE {front} / {fraction} END)"


def _t_p(t: str, df: str) -> str:
    return beta_tail(f"({df} / 2)", "CAST(0.5 AS DOUBLE)", f"({df} / ({df} + {t} * {t}))", f"({t} * {t} / ({df} + {t} * {t}))")


def _normal_cdf(z: str) -> str:
    tail = f"{gamma_tail('CAST(0.5 AS DOUBLE)', f'({z} * {z} / 2)')} / 2"
    return f"(CASE WHEN {z} < 0 THEN {tail} ELSE 1 - {tail} END)"


def _chi2_p(x: str, dof: str) -> str:
    return gamma_tail(f"(CAST({dof} AS DOUBLE) / 2)", f"({x} / 2)")


def _selected(query: str, name: str) -> str:
    """A query as a table of another one: its WITH clause stays inside."""
    return f"{name} AS ({query})"


# Normal quantiles at 0.975 and 0.8.
Z_ALPHA, Z_POWER = "1.959963984540054", "0.8416212335729143"
_NCP = f"(abs(cohens_d) * sqrt(CAST(n_a AS DOUBLE) * n_b / (CAST(n_a AS DOUBLE) + n_b)) - {Z_ALPHA})"
_F_P = beta_tail("(df2 / 2)", "(df1 / 2)", "(df2 / (df2 + df1 * f))", "(df1 * f / (df2 + df1 * f))")

_FLAGS = "lower(product_category_name_english)"

FILES_SQL: dict[str, str] = {
    "s1_trips_from_csv": _with(LINES) + """
, t AS (SELECT DISTINCT ride_id, started_at, ended_at, minutes, member_casual, station, file_month FROM kept)
SELECT file_month, member_casual, count(*) AS n_rides, CAST(sum(date_diff('second', started_at, ended_at)) AS BIGINT) AS total_sec,
       CAST(sum(minutes) AS BIGINT) AS minutes
FROM t WHERE date_diff('second', started_at, ended_at) >= 0 GROUP BY 1, 2
""",
    "s3_rejects_by_file": _with(LINES) + """
SELECT file_month, count(*) AS n_lines, count(CASE WHEN kind IN (7, 13, 21) THEN 1 END) AS n_rejected,
       count(CASE WHEN kind NOT IN (7, 13, 21) THEN 1 END) AS n_kept
FROM lines GROUP BY 1
""",
    "s3_rejected_lines": _with(LINES) + """
SELECT CASE kind WHEN 7 THEN 5 WHEN 13 THEN 6 ELSE 7 END AS n_fields, count(*) AS n_lines,
       count(CASE WHEN kind = 13 THEN 1 END) AS n_words
FROM lines WHERE kind IN (7, 13, 21) GROUP BY 1
""",
    "p18_station_numbers": _with(LINES) + """
SELECT 'Station' AS station_word, CAST(hour(started_at) AS INTEGER) AS hour, count(*) AS n, CAST(sum(station) AS BIGINT) AS sum_numbers,
       CAST(0 AS BIGINT) AS n_no_number, count(DISTINCT CAST(started_at AS DATE)) AS n_days
FROM kept GROUP BY 2
""",
    "s9_summary_round_trip": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1, 2
""",
    "s5_refreshed_sales_by_region": _with(WEEKLY_SALES) + """
SELECT region, count(*) AS n_rows, CAST(sum(transactions) AS BIGINT) AS transactions, CAST(sum(sales) AS DOUBLE) AS sales
FROM cws WHERE calendar_year = 2000 GROUP BY 1
""",
    "p20_scaled_claims": _with(CLAIMS) + "SELECT claim_order, claim_line, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS {c}" for c in NUMERIC) + " FROM claims",
    "p22_negative_numeric_columns": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(CASE WHEN {x} < 0 THEN 1 END) AS n_negative, count(CASE WHEN {x} < 0 THEN 1 END) > 0 AS has_negative FROM lineitem"
        for c, x in [*((c, c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")),
                     ("net_of_discount", "l_extendedprice * (l_discount - 0.05::DOUBLE)")]),
    "ec7_filled_products": _with(EC) + """
SELECT p.product_id, p.product_description_lenght, p.product_photos_qty, p.product_weight_g,
       p.product_length_cm * p.product_height_cm * p.product_width_cm AS volume_cm3,
       CASE WHEN t.product_category_name_english IS NOT NULL THEN t.product_category_name_english
            WHEN p.product_category_name = 'promo_ring' THEN 'promo ring' WHEN p.product_category_name = 'promo_rod' THEN 'promo rod'
       END AS product_category_name_english
FROM ec_products p LEFT JOIN ec_translation t USING (product_category_name)
WHERE p.product_id IS NOT NULL AND p.product_category_name IS NOT NULL AND p.product_description_lenght IS NOT NULL
  AND p.product_photos_qty IS NOT NULL AND p.product_weight_g IS NOT NULL AND p.product_length_cm IS NOT NULL
  AND p.product_height_cm IS NOT NULL AND p.product_width_cm IS NOT NULL
""",
    "ec7_category_flags": _with(EC) + f"""
SELECT 'is_' || {_FLAGS} AS flag, count(*) AS n_ones, (SELECT count(*) FROM ec_products_clean) AS n_rows
FROM ec_products_clean WHERE product_category_name_english IS NOT NULL GROUP BY 1
""",
    "ec7_flags_by_photos": _with(EC) + f"""
, flags AS (SELECT DISTINCT 'is_' || {_FLAGS} AS flag FROM ec_products_clean WHERE product_category_name_english IS NOT NULL)
, photos AS (SELECT product_photos_qty, count(*) AS n FROM ec_products_clean GROUP BY 1)
SELECT f.flag, q.product_photos_qty, count(CASE WHEN 'is_' || {_FLAGS} = f.flag THEN 1 END) AS n_ones
FROM flags f CROSS JOIN photos q JOIN ec_products_clean p ON p.product_photos_qty = q.product_photos_qty GROUP BY 1, 2
""",
    "ml_split_class_counts": _with(EC, MODEL_ROWS) + """
SELECT label, is_test, CASE WHEN is_test THEN n_test ELSE n - n_test END AS n
FROM sizes, (VALUES (true), (false)) t(is_test) WHERE CASE WHEN is_test THEN n_test ELSE n - n_test END > 0
""",
    "ml_fold_class_counts": _with(EC, MODEL_ROWS) + """
SELECT CAST(f AS INTEGER) AS fold, label, (n - n_test - f + 4) // 5 AS n
FROM sizes, range(5) r(f) WHERE (n - n_test - f + 4) // 5 > 0
""",
    "ml_kfold_counts": _with(EC, MODEL_ROWS) + """
, a AS (SELECT sum(n - n_test) AS n FROM sizes)
SELECT CAST(f AS INTEGER) AS fold, CAST((n - f + 4) // 5 AS BIGINT) AS n FROM a, range(5) r(f) WHERE (n - f + 4) // 5 > 0
""",
    "ml_smote_class_counts": _with(EC, MODEL_ROWS) + """
, m AS (SELECT max(n - n_test) AS most FROM sizes)
SELECT label, n - n_test AS n_original, most - (n - n_test) AS n_synthetic, most AS n_total FROM sizes, m
""",
    "in4_hotelling_pvalues": "WITH " + _selected(_hotelling("Female", "log_claim", "log_car_value"), "g") + ", " + _selected(
        _hotelling("Foreign_factor", "log_car_value", "log_claim"), "o") + f"""
, u AS (SELECT *, 'Female' AS test FROM g UNION ALL SELECT *, 'Foreign' FROM o)
SELECT *, {_F_P} AS p_value FROM u
""",
    "t3_pvalues_power_by_segment": "WITH " + _selected(
        _with(EXPERIMENT) + _two_sample("exp", "arm", "control", "treatment", "value", "event_type"), "r") + f"""
SELECT event_type, t_welch, df_welch, {_t_p('t_welch', 'df_welch')} AS p_welch, {_t_p('t_pooled', 'df_pooled')} AS p_pooled, cohens_d,
       {_normal_cdf(_NCP)} AS achieved_power,
       CAST(ceil(2 * ({Z_ALPHA} + {Z_POWER}) * ({Z_ALPHA} + {Z_POWER}) / (cohens_d * cohens_d)) AS BIGINT) AS n_per_arm_needed
FROM r
""",
    "t4_sample_ratio_pvalue": _with(EXPERIMENT) + f"""
, g AS (SELECT count(CASE WHEN arm = 'control' THEN 1 END) AS n_a, count(CASE WHEN arm = 'treatment' THEN 1 END) AS n_b FROM exp)
, x AS (SELECT *, ((n_a - (n_a + n_b) / 2.0::DOUBLE) ^ 2 + (n_b - (n_a + n_b) / 2.0::DOUBLE) ^ 2) / ((n_a + n_b) / 2.0::DOUBLE) AS srm_chi2 FROM g)
SELECT n_a, n_b, srm_chi2, {_chi2_p('srm_chi2', '1')} AS p_value FROM x
""",
    "t4_hash_assignment_balance": f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
h AS (SELECT CAST(CAST('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR), '1')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS v FROM u),
g AS (SELECT count(CASE WHEN v >= 0.5 THEN 1 END) AS n_control, count(CASE WHEN v < 0.5 THEN 1 END) AS n_treatment FROM h),
x AS (SELECT *, ((n_control - (n_control + n_treatment) / 2.0::DOUBLE) ^ 2 + (n_treatment - (n_control + n_treatment) / 2.0::DOUBLE) ^ 2)
              / ((n_control + n_treatment) / 2.0::DOUBLE) AS srm_chi2 FROM g)
SELECT *, {_chi2_p('srm_chi2', '1')} AS p_value FROM x
""",
    "t5_chi_square_pvalues": "WITH " + _selected("WITH x AS (SELECT 1)" + _chi2("lineitem", "l_returnflag", "l_linestatus"), "f") + ", " + _selected(
        _with(EXPERIMENT) + _chi2("exp", "event_type", "arm"), "e") + f"""
, u AS (SELECT *, 'returnflag_x_linestatus' AS test FROM f UNION ALL SELECT *, 'event_type_x_arm' FROM e)
SELECT chi2, dof, n, {_chi2_p('chi2', 'dof')} AS p_value, test FROM u
""",
}
