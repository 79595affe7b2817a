"""Independent DuckDB SQL for every catalog query (the correctness oracle).

The stand-in inputs are re-stated here in DuckDB SQL, and rounding is done on exact
integers (``//`` on HUGEINT) so that HALF_UP ties come out as PostgreSQL numeric
would round them -- independently of how Spark computes the same numbers.
"""

from __future__ import annotations


def rhu(num: str, den: str, k: int, scale: int = 2) -> str:
    """Integer ``q`` with ``q / 10^k = round_half_up(num / den, k)`` for two exact decimals
    with ``scale`` places (or integers with scale 0)."""
    n = f"CAST(round(({num}) * {10**scale}) AS HUGEINT)"
    d = f"CAST(round(({den}) * {10**scale}) AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d}) * "
        f"((abs({n}) * {2 * 10**k} + abs({d})) // (2 * abs({d}))) END)"
    )


def rhu_double(num: str, den: str, k: int, times: int = 1, scale: int = 2) -> str:
    """``round_half_up(num/den, k) * times`` as DOUBLE (times a power of ten <= 10^k)."""
    div = 10**k // times
    return f"(CAST({rhu(num, den, k, scale)} AS DOUBLE) / {float(div)})"


# --------------------------------------------------------------------------- weekly sales

WEEKLY_SALES = """
ws AS (
  SELECT strftime(CAST(date_trunc('week', o.o_orderdate) AS DATE), '%-d/%-m/%y') AS week_date,
         r.r_name AS region,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Retail'
              WHEN o.o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Shopify' END AS platform,
         CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'C' || CAST(c.c_custkey % 4 + 1 AS VARCHAR)
              WHEN c.c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'F' || CAST(c.c_custkey % 4 + 1 AS VARCHAR)
              ELSE 'null' END AS segment,
         CASE o.o_orderstatus WHEN 'F' THEN 'Existing' WHEN 'O' THEN 'New' WHEN 'P' THEN 'Guest' END AS customer_type,
         count(*) AS transactions,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sales
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2, 3, 4, 5
),
ws_parsed AS (
  SELECT *,
         make_date(CASE WHEN CAST(string_split(week_date, '/')[3] AS INTEGER) < 70
                        THEN 2000 + CAST(string_split(week_date, '/')[3] AS INTEGER)
                        ELSE 1900 + CAST(string_split(week_date, '/')[3] AS INTEGER) END,
                   CAST(string_split(week_date, '/')[2] AS INTEGER),
                   CAST(string_split(week_date, '/')[1] AS INTEGER)) AS clean_week_date,
         CAST(NULLIF(regexp_extract(segment, '[0-9]{1,4}'), '') AS INTEGER) AS clean_segment_number
  FROM ws
),
cws AS (
  SELECT clean_week_date,
         CAST(week(clean_week_date) AS INTEGER) AS week_number,
         CAST(month(clean_week_date) AS INTEGER) AS month_number,
         CAST(year(clean_week_date) AS INTEGER) AS calendar_year,
         region, platform, segment, clean_segment_number,
         CASE WHEN substr(segment, 1, 1) = 'C' THEN 'Couples'
              WHEN substr(segment, 1, 1) = 'F' THEN 'Families' ELSE 'unknown' END AS demographic_segment,
         CASE WHEN clean_segment_number = 1 THEN 'Young Adults'
              WHEN clean_segment_number = 2 THEN 'Middle Aged'
              WHEN clean_segment_number = 3 THEN 'Retirees' ELSE 'unknown' END AS age_band,
         customer_type, transactions, sales,
         CASE WHEN transactions = 0 THEN NULL
              ELSE CAST((CAST(round(sales * 100) AS HUGEINT) * 2 + transactions) // (2 * transactions) AS DOUBLE) / 100.0
         END AS avg_transactions
  FROM ws_parsed
)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


def _impact_dim(dim: str, k: int, times: int) -> str:
    return _with(WEEKLY_SALES) + f"""
, g AS (
  SELECT {dim},
         sum(CASE WHEN week_number BETWEEN 25 AND 36 THEN sales END) AS a,
         sum(CASE WHEN week_number BETWEEN 13 AND 24 THEN sales END) AS b,
         count(CASE WHEN week_number BETWEEN 25 AND 36 THEN 1 END) AS na,
         count(CASE WHEN week_number BETWEEN 13 AND 24 THEN 1 END) AS nb
  FROM cws WHERE week_number BETWEEN 13 AND 36 AND calendar_year = 2000
  GROUP BY {dim}
)
SELECT {dim}, CAST(a AS DOUBLE) AS total_sales, CAST(b AS DOUBLE) AS prev_tot_sales,
       CAST(a - b AS DOUBLE) AS diff_sales,
       {rhu_double('a - b', 'b', k, times)} AS perc_diff_sales
FROM g WHERE na > 0 AND nb > 0
ORDER BY perc_diff_sales ASC NULLS LAST, {dim} ASC NULLS LAST
"""


def _period_totals(b: tuple[int, int], a: tuple[int, int]) -> str:
    return _with(WEEKLY_SALES) + f"""
, g AS (
  SELECT CASE WHEN week_number BETWEEN {b[0]} AND {b[1]} THEN 'before'
              WHEN week_number BETWEEN {a[0]} AND {a[1]} THEN 'after' END AS time_period,
         sum(sales) AS total
  FROM cws WHERE week_number BETWEEN {b[0]} AND {a[1]} AND calendar_year = 2000
  GROUP BY 1
), l AS (
  SELECT time_period, total, lag(total) OVER (ORDER BY time_period DESC) AS prev FROM g
)
SELECT time_period, CAST(total AS DOUBLE) AS total_sales, CAST(prev AS DOUBLE) AS prev_total_sales,
       CAST(total - prev AS DOUBLE) AS sales_diff,
       CASE WHEN total = prev THEN NULL ELSE {rhu_double('total - prev', 'prev', 4, 100)} END AS rate_before_after
FROM l ORDER BY time_period DESC
"""


def _by_year(b: tuple[int, int], a: tuple[int, int]) -> str:
    return _with(WEEKLY_SALES) + f"""
, g AS (
  SELECT calendar_year,
         sum(CASE WHEN week_number BETWEEN {a[0]} AND {a[1]} THEN sales END) AS a,
         sum(CASE WHEN week_number BETWEEN {b[0]} AND {b[1]} THEN sales END) AS b
  FROM cws WHERE week_number BETWEEN {b[0]} AND {a[1]} AND calendar_year IN (1998, 1999, 2000)
  GROUP BY 1
)
SELECT calendar_year, CAST(a - b AS DOUBLE) AS sales_diff, CAST(b AS DOUBLE) AS prev_total_sales,
       {rhu_double('a - b', 'b', 4, 100)} AS perc_sales_change
FROM g WHERE a - b <> 0 ORDER BY calendar_year
"""


WEEKLY_SALES_SQL: dict[str, str] = {
    "dm1_clean_weekly_sales": _with(WEEKLY_SALES) + """
SELECT clean_week_date, week_number, month_number, calendar_year, region, platform, segment,
       clean_segment_number, demographic_segment, age_band, customer_type, transactions,
       CAST(sales AS DOUBLE) AS sales, avg_transactions
FROM cws
""",
    "dm2_week_day_names": _with(WEEKLY_SALES) + """
SELECT clean_week_date, rpad(lower(dayname(clean_week_date)), 9, ' ') AS week_day
FROM cws ORDER BY clean_week_date
""",
    "dm3_missing_weeks": _with(WEEKLY_SALES) + """
, gen AS (SELECT CAST(range AS BIGINT) AS week_number FROM range(1, 53))
SELECT g.week_number FROM gen g
WHERE NOT EXISTS (SELECT 1 FROM cws c WHERE c.week_number = g.week_number)
ORDER BY 1
""",
    "dm3_missing_weeks_2001": _with(WEEKLY_SALES) + """
, gen AS (SELECT CAST(range AS BIGINT) AS week_number FROM range(1, 53))
SELECT g.week_number FROM gen g
WHERE NOT EXISTS (SELECT 1 FROM cws c WHERE c.week_number = g.week_number AND c.calendar_year = 2001)
ORDER BY 1
""",
    "dm4_yearly_transactions": _with(WEEKLY_SALES) + """
SELECT calendar_year, count(*) AS total_trx_count, CAST(sum(transactions) AS BIGINT) AS total_trx
FROM cws GROUP BY 1
""",
    "dm5_region_month_sales_top7": _with(WEEKLY_SALES) + """
SELECT region, calendar_year, month_number, CAST(sum(sales) AS DOUBLE) AS total_sales
FROM cws GROUP BY 1, 2, 3
ORDER BY calendar_year, month_number, region LIMIT 7
""",
    "dm6_platform_transactions": _with(WEEKLY_SALES) + """
SELECT platform, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM ws GROUP BY 1
""",
    "dm7_platform_share_monthly": _with(WEEKLY_SALES) + f"""
, g AS (SELECT platform, calendar_year, month_number, sum(sales) AS part FROM cws GROUP BY 1, 2, 3)
, t AS (SELECT calendar_year, month_number, sum(part) AS total FROM g GROUP BY 1, 2)
SELECT g.platform, g.calendar_year, g.month_number,
       {rhu_double('g.part', 't.total', 3, 100)} AS perc_per_platform
FROM g JOIN t USING (calendar_year, month_number)
ORDER BY g.calendar_year, g.month_number, g.platform
""",
    "dm8_demographic_share_yearly": _with(WEEKLY_SALES) + f"""
, g AS (SELECT demographic_segment, calendar_year, sum(sales) AS part FROM cws GROUP BY 1, 2)
, t AS (SELECT calendar_year, sum(part) AS total FROM g GROUP BY 1)
SELECT g.demographic_segment, g.calendar_year,
       {rhu_double('g.part', 't.total', 2, 100)} AS perc_per_dem,
       CAST(g.part AS DOUBLE) AS sales_per_dem
FROM g JOIN t USING (calendar_year)
ORDER BY g.calendar_year, g.demographic_segment
""",
    "dm9_retail_age_demo_share": _with(WEEKLY_SALES) + f"""
, g AS (SELECT age_band, demographic_segment, sum(sales) AS part FROM cws WHERE platform = 'Retail' GROUP BY 1, 2)
, t AS (SELECT sum(part) AS total FROM g)
SELECT g.age_band, g.demographic_segment,
       {rhu_double('g.part', 't.total', 2, 100)} AS total_sales_pc
FROM g, t
ORDER BY total_sales_pc DESC, age_band, demographic_segment
""",
    "dm10_avg_transaction": _with(WEEKLY_SALES) + f"""
SELECT calendar_year, platform,
       CAST((CAST(round(sum(sales) * 100) AS HUGEINT) * 2 + sum(transactions)) // (2 * sum(transactions)) AS DOUBLE) / 100.0
         AS avg_annual_transaction
FROM cws GROUP BY 1, 2 ORDER BY 1, 2
""",
    "dm11_before_after_4w": _period_totals((21, 24), (25, 28)),
    "dm12_before_after_12w": _period_totals((13, 24), (25, 36)),
    "dm13_yearly_change_4w": _by_year((21, 24), (25, 28)),
    "dm14_yearly_change_12w": _by_year((13, 24), (25, 36)),
    "dm15_impact_by_region": _impact_dim("region", 3, 100),
    "dm16_impact_by_platform": _impact_dim("platform", 3, 100),
    "dm17_impact_by_age_band": _impact_dim("age_band", 3, 100),
    "dm18_impact_by_demographic": _impact_dim("demographic_segment", 4, 100),
    "dm19_impact_by_customer_type": _impact_dim("customer_type", 4, 100),
    "dm_impact_all_dimensions": _with(WEEKLY_SALES) + f"""
, base AS (
  SELECT region, platform, age_band, demographic_segment, customer_type,
         CASE WHEN week_number BETWEEN 13 AND 24 THEN 'before' ELSE 'after' END AS p, sales
  FROM cws WHERE week_number BETWEEN 13 AND 36 AND calendar_year = 2000
), g AS (
  SELECT 'region' AS dimension, region AS value, p, sales FROM base
  UNION ALL SELECT 'platform', platform, p, sales FROM base
  UNION ALL SELECT 'age_band', age_band, p, sales FROM base
  UNION ALL SELECT 'demographic_segment', demographic_segment, p, sales FROM base
  UNION ALL SELECT 'customer_type', customer_type, p, sales FROM base
), s AS (
  SELECT dimension, value,
         sum(CASE WHEN p = 'after' THEN sales END) AS a, sum(CASE WHEN p = 'before' THEN sales END) AS b,
         count(CASE WHEN p = 'after' THEN 1 END) AS na, count(CASE WHEN p = 'before' THEN 1 END) AS nb
  FROM g GROUP BY 1, 2
)
SELECT dimension, value, CAST(a AS DOUBLE) AS total_sales, CAST(b AS DOUBLE) AS prev_tot_sales,
       CAST(a - b AS DOUBLE) AS diff_sales, {rhu_double('a - b', 'b', 3, 100)} AS perc_diff_sales
FROM s WHERE na > 0 AND nb > 0
""",
}


# --------------------------------------------------------------------------- web events

WEB = """
we AS (
  SELECT event_id, 'c' || CAST(user_id AS VARCHAR) AS cookie_id,
         'c' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS visit_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 + 1 AS page_id,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                         WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS event_type,
         ts AS event_time
  FROM events
),
users_ AS (SELECT DISTINCT user_id // 2 AS user_id, 'c' || CAST(user_id AS VARCHAR) AS cookie_id FROM events),
ei AS (SELECT * FROM (VALUES (1, 'Page View'), (2, 'Add to Cart'), (3, 'Purchase'), (4, 'Ad Impression'),
                             (5, 'Ad Click')) t(event_type, event_name)),
ph AS (SELECT * FROM (VALUES (1, 'Home Page', NULL, NULL), (2, 'All Products', NULL, NULL),
         (3, 'Salmon', 'Fish', 1), (4, 'Kingfish', 'Fish', 2), (5, 'Tuna', 'Fish', 3),
         (6, 'Russian Caviar', 'Luxury', 4), (7, 'Black Truffle', 'Luxury', 5),
         (8, 'Abalone', 'Shellfish', 6), (9, 'Lobster', 'Shellfish', 7), (10, 'Crab', 'Shellfish', 8),
         (11, 'Oyster', 'Shellfish', 9), (12, 'Checkout', NULL, NULL), (13, 'Confirmation', NULL, NULL))
       t(page_id, page_name, product_category, product_id)),
ci AS (SELECT * FROM (VALUES ('BOGOF - Fishing For Compliments', DATE '2024-01-01', DATE '2024-01-10'),
         ('25% Off - Living The Lux Life', DATE '2024-01-08', DATE '2024-01-15'),
         ('Half Off - Treat Your Shellf(ish)', DATE '2024-01-20', DATE '2024-01-31'))
       t(campaign_name, start_date, end_date))
"""

VISIT_SUMMARY = _with(WEB) + """
, e AS (SELECT we.*, u.user_id, ei.event_name, ph.page_name
        FROM we JOIN users_ u USING (cookie_id) JOIN ei USING (event_type) LEFT JOIN ph USING (page_id))
, v AS (
  SELECT visit_id, user_id, CAST(min(event_time) AS DATE) AS earliest_visit,
         string_agg(CASE WHEN event_name = 'Add to Cart' THEN page_name END, ', ' ORDER BY event_time, event_id)
           AS cart_products,
         count(CASE WHEN event_name = 'Page View' THEN 1 END) AS page_view_count,
         count(CASE WHEN event_name = 'Add to Cart' THEN 1 END) AS add_to_cart_count,
         max(CASE WHEN event_name = 'Purchase' THEN 1 ELSE 0 END) AS purchase_flag,
         count(CASE WHEN event_name = 'Ad Impression' THEN 1 END) AS ad_impression_count
  FROM e GROUP BY visit_id, user_id
)
, vs AS (SELECT v.*, ci.campaign_name FROM v LEFT JOIN ci ON v.earliest_visit BETWEEN ci.start_date AND ci.end_date)
"""

WEB_SQL: dict[str, str] = {
    "cb1_user_count": _with(WEB) + "SELECT count(DISTINCT user_id) AS n_users FROM users_",
    "cb2_cookies_per_user": _with(WEB) + f"""
, a AS (SELECT user_id, count(cookie_id) AS num_cookies FROM users_ GROUP BY 1)
, b AS (SELECT CAST(sum(num_cookies) AS BIGINT) AS total_cookies, count(DISTINCT user_id) AS n_users FROM a)
SELECT total_cookies, n_users, {rhu_double('total_cookies', 'n_users', 2, 1, 0)} AS avg_cookie_count FROM b
""",
    "cb3_visits_per_month": _with(WEB) + """
SELECT CAST(date_trunc('month', event_time) AS DATE) AS event_month, count(DISTINCT visit_id) AS unique_visit_count
FROM we WHERE cookie_id IN (SELECT cookie_id FROM users_) GROUP BY 1
""",
    "cb3_visits_per_day": _with(WEB) + """
SELECT CAST(date_trunc('day', event_time) AS DATE) AS event_day, count(DISTINCT visit_id) AS unique_visit_count
FROM we WHERE cookie_id IN (SELECT cookie_id FROM users_) GROUP BY 1
""",
    "cb4_events_per_type": _with(WEB) + """
SELECT we.event_type, ei.event_name, count(we.event_type) AS n_events
FROM we JOIN ei ON we.event_type = ei.event_type GROUP BY 1, 2 ORDER BY 1
""",
    "cb5_event_share": _with(WEB) + f"""
, a AS (SELECT ei.event_name, count(we.visit_id) AS total_visits_per_event
        FROM we JOIN ei ON we.event_type = ei.event_type GROUP BY 1)
, t AS (SELECT CAST(sum(total_visits_per_event) AS BIGINT) AS total_visits FROM a)
SELECT a.event_name, a.total_visits_per_event, t.total_visits,
       {rhu_double('a.total_visits_per_event', 't.total_visits', 4, 100, 0)} AS perc_visit
FROM a, t
""",
    "cb6_purchase_visit_pct": _with(WEB) + """
SELECT (SELECT count(DISTINCT we.visit_id) FROM we JOIN ei ON we.event_type = ei.event_type
        WHERE ei.event_name = 'Purchase') * 100 // (SELECT count(DISTINCT visit_id) FROM we)
       AS purchase_visit_pct
""",
    "cb7_purchase_pct_by_flags": _with(WEB) + f"""
, a AS (SELECT we.visit_id, sum(CASE WHEN event_name = 'Purchase' THEN 1 ELSE 0 END) AS purchase_event
        FROM we JOIN ei ON ei.event_type = we.event_type GROUP BY 1)
SELECT {rhu_double('sum(purchase_event)', 'count(*)', 4, 100, 0)} AS purchase_perc FROM a
""",
    "cb8_checkout_no_purchase_pct": _with(WEB) + f"""
, a AS (SELECT we.visit_id,
          sum(CASE WHEN ei.event_name = 'Page View' AND ph.page_name = 'Checkout' THEN 1 ELSE 0 END) AS checkout_count,
          sum(CASE WHEN ei.event_name = 'Purchase' AND ph.page_name = 'Confirmation' THEN 1 ELSE 0 END) AS purchase_count
        FROM we JOIN ei ON we.event_type = ei.event_type JOIN ph ON we.page_id = ph.page_id GROUP BY 1)
SELECT {rhu_double('sum(CASE WHEN checkout_count = 1 AND purchase_count = 0 THEN 1 ELSE 0 END)', 'count(*)', 4, 100, 0)}
       AS perc_no_purchase FROM a
""",
    "cb9_top3_pages": _with(WEB) + """
SELECT ph.page_name, count(*) AS n_views FROM we JOIN ph ON we.page_id = ph.page_id
WHERE we.event_type = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3
""",
    "cb10_visit_summary": VISIT_SUMMARY + "SELECT * FROM vs",
    "cb11_category_views_adds": _with(WEB) + """
SELECT ph.product_category,
       count(CASE WHEN ei.event_name = 'Page View' THEN 1 END) AS page_views,
       count(CASE WHEN ei.event_name = 'Add to Cart' THEN 1 END) AS cart_adds
FROM we JOIN ei USING (event_type) JOIN ph USING (page_id)
WHERE ph.product_category IS NOT NULL GROUP BY 1
""",
    "cb11_product_funnel": _with(WEB) + f"""
, e AS (SELECT we.*, ei.event_name FROM we JOIN ei USING (event_type))
, b AS (SELECT visit_id, max(CASE WHEN event_name = 'Purchase' THEN 1 ELSE 0 END) AS bought FROM e GROUP BY 1)
, g AS (SELECT ph.page_name,
               count(CASE WHEN event_name = 'Page View' THEN 1 END) AS page_views,
               count(CASE WHEN event_name = 'Add to Cart' THEN 1 END) AS cart_adds,
               count(CASE WHEN event_name = 'Add to Cart' AND bought = 1 THEN 1 END) AS purchases
        FROM e JOIN ph USING (page_id) JOIN b USING (visit_id)
        WHERE ph.product_category IS NOT NULL GROUP BY 1)
SELECT page_name, page_views, cart_adds, purchases, cart_adds - purchases AS abandoned,
       {rhu_double('cart_adds', 'page_views', 4, 100, 0)} AS view_to_cart_pct,
       {rhu_double('purchases', 'cart_adds', 4, 100, 0)} AS cart_to_purchase_pct
FROM g
""",
    "cb11_campaign_effect": VISIT_SUMMARY + f"""
SELECT campaign_name, count(*) AS visits,
       CAST(sum(page_view_count) AS DOUBLE) / count(*) AS avg_page_views,
       CAST(sum(add_to_cart_count) AS DOUBLE) / count(*) AS avg_cart_adds,
       CAST(sum(ad_impression_count) AS DOUBLE) / count(*) AS avg_impressions,
       {rhu_double('sum(purchase_flag)', 'count(*)', 4, 100, 0)} AS purchase_rate_pct
FROM vs GROUP BY 1
""",
    "cb_visit_funnel": _with(WEB) + f"""
, e AS (SELECT we.visit_id, ei.event_name, ph.page_name, ph.product_category
        FROM we JOIN ei USING (event_type) LEFT JOIN ph USING (page_id))
, v AS (SELECT visit_id,
          max(CASE WHEN event_name = 'Page View' AND product_category IS NOT NULL THEN 1 ELSE 0 END) AS product_view,
          max(CASE WHEN event_name = 'Add to Cart' THEN 1 ELSE 0 END) AS cart_add,
          max(CASE WHEN event_name = 'Page View' AND page_name = 'Checkout' THEN 1 ELSE 0 END) AS checkout_view,
          max(CASE WHEN event_name = 'Purchase' THEN 1 ELSE 0 END) AS purchase
        FROM e GROUP BY 1)
, t AS (SELECT count(*) AS k, sum(product_view) AS s1, sum(cart_add) AS s2, sum(checkout_view) AS s3,
               sum(purchase) AS s4 FROM v)
, s AS (SELECT 'product_view' AS step, 1 AS position, s1 AS n, k AS prev, k FROM t
        UNION ALL SELECT 'cart_add', 2, s2, s1, k FROM t
        UNION ALL SELECT 'checkout_view', 3, s3, s2, k FROM t
        UNION ALL SELECT 'purchase', 4, s4, s3, k FROM t)
SELECT step, position, CAST(n AS BIGINT) AS n_keys,
       {rhu_double('n', 'k', 4, 100, 0)} AS pct_of_keys,
       100.0 - {rhu_double('n', 'prev', 4, 100, 0)} AS drop_off_pct
FROM s
""",
}


# --------------------------------------------------------------------------- trips

TRIPS = """
raw_trips AS (
  SELECT o.o_orderdate + to_hours(CAST(l.l_quantity AS INTEGER) % 24) AS started_at,
         l.l_shipdate AS ended_at,
         CASE l.l_linestatus WHEN 'O' THEN 'member' WHEN 'F' THEN 'casual' END AS member_casual,
         CASE l.l_returnflag WHEN 'A' THEN 'classic_bike' WHEN 'N' THEN 'docked_bike'
                             WHEN 'R' THEN 'electric_bike' END AS rideable_type,
         'Station ' || CAST(l.l_suppkey AS VARCHAR) AS start_station_name,
         'Dock ' || CAST(l.l_partkey % 50 AS VARCHAR) AS end_station_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
trips AS (
  SELECT *, CAST(month(started_at) AS INTEGER) AS month, CAST(year(started_at) AS INTEGER) AS year,
         date_diff('second', started_at, ended_at) AS ride_length_sec,
         CAST(isodow(started_at) - 1 AS INTEGER) AS day_of_week,
         strftime(started_at, '%H') AS time_stamp_hour
  FROM (SELECT DISTINCT * FROM raw_trips)
  WHERE date_diff('second', started_at, ended_at) >= 0
)
"""

DAY_CASE = ("CASE {c} WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' "
            "WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' WHEN 6 THEN 'Sunday' END")


def _mode_sql(value: str, name: str) -> str:
    """Mode per (member_casual, year, month) of one column; ties to the smallest value as text."""
    return f"""
{name} AS (
  SELECT member_casual, year, month, v AS top_{value}, n AS n_{value} FROM (
    SELECT *, row_number() OVER (PARTITION BY member_casual, year, month ORDER BY n DESC, v) AS rn
    FROM (SELECT member_casual, year, month, CAST({value} AS VARCHAR) AS v, count(*) AS n
          FROM trips WHERE {value} IS NOT NULL GROUP BY 1, 2, 3, 4))
  WHERE rn = 1
)"""


TRIPS_SQL: dict[str, str] = {
    "bk1_clean_trips": _with(TRIPS) + """
SELECT started_at, ended_at, member_casual, rideable_type, start_station_name, end_station_name,
       month, year, ride_length_sec, day_of_week FROM trips
""",
    "bk2_favourite_day": _with(TRIPS, _mode_sql("day_of_week", "m")) + f"""
SELECT member_casual, year, month, {DAY_CASE.format(c='CAST(top_day_of_week AS INTEGER)')} AS favourite_day,
       n_day_of_week AS n_rides FROM m
""",
    "bk3_ride_length": _with(TRIPS) + """
SELECT member_casual, year, month, avg(ride_length_sec) AS avg_ride_length_sec,
       CAST(sum(ride_length_sec) AS BIGINT) AS total_ride_length_sec
FROM trips GROUP BY 1, 2, 3
""",
    "bk4_top_stations": _with(TRIPS, _mode_sql("start_station_name", "s"), _mode_sql("end_station_name", "e")) + """
SELECT s.member_casual, s.year, s.month, top_start_station_name, n_start_station_name,
       top_end_station_name, n_end_station_name
FROM s JOIN e USING (member_casual, year, month)
""",
    "bk5_peak_hour": _with(TRIPS, _mode_sql("time_stamp_hour", "h")) + """
SELECT member_casual, year, month, top_time_stamp_hour, n_time_stamp_hour FROM h
""",
    "bk6_monthly_summary": _with(
        TRIPS,
        _mode_sql("day_of_week", "d"),
        _mode_sql("start_station_name", "s"),
        _mode_sql("end_station_name", "e"),
        _mode_sql("time_stamp_hour", "h"),
    ) + f"""
, l AS (SELECT member_casual, year, month, avg(ride_length_sec) AS avg_ride_length_sec,
               CAST(sum(ride_length_sec) AS BIGINT) AS total_ride_length_sec FROM trips GROUP BY 1, 2, 3)
SELECT l.year, l.month, l.member_casual AS membership,
       {DAY_CASE.format(c='CAST(d.top_day_of_week AS INTEGER)')} AS favourite_day,
       avg_ride_length_sec, total_ride_length_sec,
       top_start_station_name AS top_start_station, top_end_station_name AS top_end_station,
       top_time_stamp_hour || ':00' AS peak_hour_time, n_time_stamp_hour AS n_at_peak_hour
FROM l JOIN d USING (member_casual, year, month) JOIN s USING (member_casual, year, month)
     JOIN e USING (member_casual, year, month) JOIN h USING (member_casual, year, month)
ORDER BY 1, 2, 3
""",
    "bk7_ride_types": _with(TRIPS) + """
SELECT member_casual, rideable_type, count(*) AS count FROM trips
WHERE member_casual IS NOT NULL AND rideable_type IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2
""",
    "bk8_rides_per_hour": _with(TRIPS) + """
SELECT member_casual, time_stamp_hour, count(*) AS count FROM trips
WHERE member_casual IS NOT NULL AND time_stamp_hour IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2
""",
}


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(WEEKLY_SALES_SQL)
    out.update(WEB_SQL)
    out.update(TRIPS_SQL)
    from ledgerline.plans.oracle_orders import ORDERS_SQL

    out.update(ORDERS_SQL)
    from ledgerline.plans.oracle_stats import STATS_SQL

    out.update(STATS_SQL)
    from ledgerline.plans.oracle_ml import ML_SQL

    out.update(ML_SQL)
    from ledgerline.plans.oracle_files import FILES_SQL

    out.update(FILES_SQL)
    from ledgerline.plans.oracle_models import MODELS_SQL

    out.update(MODELS_SQL)
    return out
