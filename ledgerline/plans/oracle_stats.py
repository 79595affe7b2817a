"""DuckDB oracle SQL for the claim statistics (IN*) and experiment read-outs (T*)."""

from __future__ import annotations

from ledgerline.plans.oracle import _with
from ledgerline.plans.oracle_orders import EC

CLAIMS = """
claims AS (
  SELECT l.l_orderkey AS claim_order, l.l_linenumber AS claim_line, l.l_partkey AS claim_part,
         CAST(l.l_linestatus = 'F' AS INTEGER) AS Female,
         CAST(18 + o.o_custkey % 60 AS DOUBLE) AS Age,
         l.l_quantity * 50 AS Engine_Capacity,
         CAST(l.l_linenumber AS DOUBLE) AS Vehicle_Age,
         l.l_extendedprice AS Car_Value,
         o.o_totalprice * (l.l_discount + l.l_tax) AS Claim_Amount,
         CASE l.l_returnflag WHEN 'A' THEN 'EUROPE' WHEN 'N' THEN 'EAST ASIA' WHEN 'R' THEN 'LOCAL' END
           AS Vehicle_Make_Region,
         CAST(l.l_discount >= 0.05 AS INTEGER) AS Claim_Amount_Indicator
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
claims_r AS (
  SELECT *, CASE WHEN Vehicle_Make_Region IN ('EUROPE', 'EAST ASIA') THEN 'FOREIGN'
                 ELSE Vehicle_Make_Region END AS "Foreign"
  FROM claims
),
claims_f AS (SELECT *, CASE WHEN "Foreign" = 'LOCAL' THEN 0 ELSE 1 END AS Foreign_factor FROM claims_r),
logged AS (
  SELECT *, ln(Claim_Amount) AS log_claim, ln(Car_Value) AS log_car_value
  FROM claims_f WHERE Claim_Amount > 0 AND Car_Value > 0
)
"""

NUMERIC = ["Age", "Engine_Capacity", "Vehicle_Age", "Car_Value", "Claim_Amount"]


def _corr() -> str:
    parts = []
    for i, a in enumerate(NUMERIC):
        for b in NUMERIC[i:]:
            parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, corr({a}, {b}) AS corr FROM claims")
    return _with(CLAIMS) + "\nUNION ALL\n".join(parts)


def _hotelling(group: str, v1: str, v2: str) -> str:
    return _with(CLAIMS) + f"""
, g AS (SELECT {group} AS grp, count(*) AS n, avg({v1}) AS m1, avg({v2}) AS m2,
               var_samp({v1}) AS s11, var_samp({v2}) AS s22, covar_samp({v1}, {v2}) AS s12
        FROM logged WHERE {group} IN (0, 1) GROUP BY 1)
, a AS (SELECT * FROM g WHERE grp = 0), b AS (SELECT * FROM g WHERE grp = 1)
, p AS (SELECT a.n AS n1, b.n AS n2, a.m1 - b.m1 AS d1, a.m2 - b.m2 AS d2,
               ((a.n - 1) * a.s11 + (b.n - 1) * b.s11) / (a.n + b.n - 2) AS s11,
               ((a.n - 1) * a.s22 + (b.n - 1) * b.s22) / (a.n + b.n - 2) AS s22,
               ((a.n - 1) * a.s12 + (b.n - 1) * b.s12) / (a.n + b.n - 2) AS s12
        FROM a, b)
, t AS (SELECT n1, n2, CAST(n1 * n2 AS DOUBLE) / (n1 + n2) * (d1 * d1 * s22 - 2 * d1 * d2 * s12 + d2 * d2 * s11)
                      / (s11 * s22 - s12 * s12) AS t2 FROM p)
SELECT n1, n2, t2, (n1 + n2 - 3) / ((n1 + n2 - 2) * 2.0) * t2 AS f, CAST(2 AS DOUBLE) AS df1, CAST(n1 + n2 - 3 AS DOUBLE) AS df2
FROM t
"""


_POP = """
, pop AS (
  SELECT 'Female=' || CAST(Female AS VARCHAR) AS population, log_claim, log_car_value FROM logged
  UNION ALL SELECT 'Foreign_factor=' || CAST(Foreign_factor AS VARCHAR), log_claim, log_car_value FROM logged
)
"""

EXPERIMENT = """
exp AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'treatment' END AS arm FROM events)
"""


def _two_sample(src: str, arm: str, a: str, b: str, value: str, by: str | None) -> str:
    key = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
, s AS (
  SELECT {key}
         count(CASE WHEN {arm} = '{a}' THEN {value} END) AS n_a, count(CASE WHEN {arm} = '{b}' THEN {value} END) AS n_b,
         avg(CASE WHEN {arm} = '{a}' THEN {value} END) AS mean_a, avg(CASE WHEN {arm} = '{b}' THEN {value} END) AS mean_b,
         var_samp(CASE WHEN {arm} = '{a}' THEN {value} END) AS var_a,
         var_samp(CASE WHEN {arm} = '{b}' THEN {value} END) AS var_b
  FROM {src} WHERE {arm} IN ('{a}', '{b}') {grp}
)
SELECT {key} n_a, n_b, mean_a, mean_b, var_a, var_b, mean_b - mean_a AS mean_diff,
       (mean_b - mean_a) / sqrt(var_a / n_a + var_b / n_b) AS t_welch,
       (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
         / ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) AS df_welch,
       (mean_b - mean_a) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2) * (1.0 / n_a + 1.0 / n_b))
         AS t_pooled,
       CAST(n_a + n_b - 2 AS DOUBLE) AS df_pooled,
       (mean_b - mean_a) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)) AS cohens_d
FROM s
"""


def _chi2(src: str, a: str, b: str) -> str:
    return f"""
, cells AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)
, ra AS (SELECT a, sum(o) AS ra FROM cells GROUP BY 1)
, cb AS (SELECT b, sum(o) AS cb FROM cells GROUP BY 1)
, tot AS (SELECT sum(o) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS c FROM cells)
, grid AS (SELECT ra.a, cb.b, CAST(ra.ra AS DOUBLE) * cb.cb / tot.n AS e FROM ra, cb, tot)
SELECT sum((coalesce(cells.o, 0) - grid.e) * (coalesce(cells.o, 0) - grid.e) / grid.e) AS chi2,
       (SELECT (r - 1) * (c - 1) FROM tot) AS dof, CAST((SELECT n FROM tot) AS BIGINT) AS n
FROM grid LEFT JOIN cells ON grid.a = cells.a AND grid.b = cells.b
"""


STATS_SQL: dict[str, str] = {
    "in1_correlation_matrix": _corr(),
    "in2_claim_boxes": _with(CLAIMS) + """
, src AS (
  SELECT 'Female' AS grouping, CAST(Female AS VARCHAR) AS group_value, Claim_Amount AS x FROM claims
  UNION ALL SELECT 'Vehicle_Make_Region', Vehicle_Make_Region, Claim_Amount FROM claims
  UNION ALL SELECT 'Claim_Amount_Indicator', CAST(Claim_Amount_Indicator AS VARCHAR), Claim_Amount FROM claims
)
, q AS (SELECT grouping, group_value, count(x) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
               quantile_cont(x, 0.75) AS q3 FROM src GROUP BY 1, 2)
, f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
, e AS (SELECT f.grouping, f.group_value,
               min(CASE WHEN x BETWEEN lower_fence AND upper_fence THEN x END) AS whisker_low,
               max(CASE WHEN x BETWEEN lower_fence AND upper_fence THEN x END) AS whisker_high,
               count(CASE WHEN NOT (x BETWEEN lower_fence AND upper_fence) THEN 1 END) AS n_outliers
        FROM src JOIN f ON src.grouping = f.grouping AND src.group_value IS NOT DISTINCT FROM f.group_value
        WHERE x IS NOT NULL GROUP BY 1, 2)
SELECT f.grouping, f.group_value, n, q1, median, q3, lower_fence, upper_fence, whisker_low, whisker_high, n_outliers
FROM f LEFT JOIN e ON f.grouping = e.grouping AND f.group_value IS NOT DISTINCT FROM e.group_value
""",
    "in4_hotelling_gender": _hotelling("Female", "log_claim", "log_car_value"),
    "in4_hotelling_origin": _hotelling("Foreign_factor", "log_car_value", "log_claim"),
    "in4_group_covariances": _with(CLAIMS) + _POP + """
SELECT population, count(*) AS n, 'log_claim' AS var_a, 'log_claim' AS var_b, covar_samp(log_claim, log_claim) AS cov
FROM pop GROUP BY 1
UNION ALL SELECT population, count(*), 'log_claim', 'log_car_value', covar_samp(log_claim, log_car_value) FROM pop GROUP BY 1
UNION ALL SELECT population, count(*), 'log_car_value', 'log_car_value', covar_samp(log_car_value, log_car_value)
FROM pop GROUP BY 1
""",
    "in4_group_means": _with(CLAIMS) + _POP + """
SELECT population, avg(log_claim) AS mean_log_claim, avg(log_car_value) AS mean_log_car_value FROM pop GROUP BY 1
""",
    "t1_welch_by_segment": _with(EXPERIMENT) + _two_sample("exp", "arm", "control", "treatment", "value", "event_type"),
    "t1_welch_overall": _with(EXPERIMENT) + _two_sample("exp", "arm", "control", "treatment", "value", None),
    "t4_error_rate_by_arm": _with(EXPERIMENT) + """
, g AS (
  SELECT count(CASE WHEN arm = 'control' THEN 1 END) AS n_a, count(CASE WHEN arm = 'treatment' THEN 1 END) AS n_b,
         count(CASE WHEN arm = 'control' AND event_type = 'error' THEN 1 END) AS x_a,
         count(CASE WHEN arm = 'treatment' AND event_type = 'error' THEN 1 END) AS x_b,
         sum(CASE WHEN arm = 'control' AND event_type = 'error' THEN value END) AS cost_a,
         sum(CASE WHEN arm = 'treatment' AND event_type = 'error' THEN value END) AS cost_b
  FROM exp WHERE arm IN ('control', 'treatment')
)
SELECT *, CAST(x_a AS DOUBLE) / n_a AS rate_a, CAST(x_b AS DOUBLE) / n_b AS rate_b,
       CAST(x_b AS DOUBLE) / n_b - CAST(x_a AS DOUBLE) / n_a AS rate_diff,
       CAST(x_b AS DOUBLE) / n_b - CAST(x_a AS DOUBLE) / n_a - 1.959963984540054 * sqrt(
         (CAST(x_a AS DOUBLE) / n_a) * (1 - CAST(x_a AS DOUBLE) / n_a) / n_a
         + (CAST(x_b AS DOUBLE) / n_b) * (1 - CAST(x_b AS DOUBLE) / n_b) / n_b) AS ci_low,
       CAST(x_b AS DOUBLE) / n_b - CAST(x_a AS DOUBLE) / n_a + 1.959963984540054 * sqrt(
         (CAST(x_a AS DOUBLE) / n_a) * (1 - CAST(x_a AS DOUBLE) / n_a) / n_a
         + (CAST(x_b AS DOUBLE) / n_b) * (1 - CAST(x_b AS DOUBLE) / n_b) / n_b) AS ci_high,
       ((n_a - (n_a + n_b) / 2.0) ^ 2 + (n_b - (n_a + n_b) / 2.0) ^ 2) / ((n_a + n_b) / 2.0) AS srm_chi2
FROM g
""",
    "t5_chi_square_flags": "WITH x AS (SELECT 1)" + _chi2("lineitem", "l_returnflag", "l_linestatus"),
    "t5_chi_square_event_arm": _with(EXPERIMENT) + _chi2("exp", "event_type", "arm"),
    "t6_totalprice_by_status": "WITH x AS (SELECT 1)" + _two_sample("orders", "o_orderstatus", "F", "O",
                                                                    "o_totalprice", None),
    "t13_review_trend": _with(EC) + """
SELECT CAST(date_trunc('month', o.o_orderdate + INTERVAL 40 DAY) AS DATE) AS review_month,
       trim(c.customer_state) AS customer_state,
       avg(r.review_score) AS mean_score, count(*) AS n_reviews
FROM ec_reviews r JOIN orders o ON r.order_id = o.o_orderkey
LEFT JOIN ec_customers c ON o.o_custkey = c.customer_id
GROUP BY 1, 2
""",
}
