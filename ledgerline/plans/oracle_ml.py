"""DuckDB oracle SQL for the classification metrics over the rule baseline."""

from __future__ import annotations

BASE = """
WITH b AS (
  SELECT l_returnflag AS label,
         CASE WHEN l_discount < 0.04 THEN 'A' WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END AS prediction,
         l_discount AS score
  FROM lineitem
),
cm AS (SELECT label, prediction, count(*) AS count FROM b GROUP BY 1, 2),
classes AS (SELECT label AS cls FROM cm UNION SELECT prediction FROM cm),
per AS (
  SELECT c.cls,
         coalesce(sum(CASE WHEN cm.label = c.cls AND cm.prediction = c.cls THEN cm.count END), 0) AS tp,
         coalesce(sum(CASE WHEN cm.label <> c.cls AND cm.prediction = c.cls THEN cm.count END), 0) AS fp,
         coalesce(sum(CASE WHEN cm.label = c.cls AND cm.prediction <> c.cls THEN cm.count END), 0) AS fn,
         coalesce(sum(CASE WHEN cm.label = c.cls THEN cm.count END), 0) AS support
  FROM classes c, cm GROUP BY 1
),
m AS (
  SELECT cls, support, tp, fp,
         CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall
  FROM per
),
mf AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM m
)
"""

SEGMENTS = BASE + """
, s AS (SELECT c.cls, CAST(b.score AS DOUBLE) AS score, CAST(b.label = c.cls AS INTEGER) AS y
        FROM b, (VALUES ('A'), ('N'), ('R')) c(cls))
, cnt AS (SELECT cls, score, sum(y) AS p, sum(1 - y) AS n FROM s GROUP BY 1, 2)
, cum AS (SELECT cls, score, p, n, sum(p) OVER (PARTITION BY cls ORDER BY score DESC) AS cp,
                 sum(n) OVER (PARTITION BY cls ORDER BY score DESC) AS cn,
                 sum(p) OVER (PARTITION BY cls) AS np, sum(n) OVER (PARTITION BY cls) AS nn FROM cnt)
, seg AS (SELECT cls, score, CAST(cp AS DOUBLE) / np AS tpr, CAST(cn AS DOUBLE) / nn AS fpr,
                 CAST(cp - p AS DOUBLE) / np AS tpr0, CAST(cn - n AS DOUBLE) / nn AS fpr0 FROM cum)
"""

ML_SQL: dict[str, str] = {
    "ml_baseline_confusion": BASE + "SELECT label, prediction, count FROM cm",
    "ml_baseline_report": BASE + """
, t AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
               sum(f1 * support) / sum(support) AS wf FROM mf)
SELECT cls, precision, recall, f1, CAST(support AS BIGINT) AS support FROM mf
UNION ALL SELECT 'accuracy', CAST(tp AS DOUBLE) / n, CAST(tp AS DOUBLE) / n, CAST(tp AS DOUBLE) / n, CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', mp, mr, mf, CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'weighted avg', wp, wr, wf, CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'micro avg', CAST(tp AS DOUBLE) / n, CAST(tp AS DOUBLE) / n, CAST(tp AS DOUBLE) / n, CAST(n AS BIGINT) FROM t
""",
    "ml_baseline_hard_auc": BASE + """
, t AS (SELECT sum(support) AS n FROM per)
SELECT cls,
       CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS tpr,
       CASE WHEN n - support > 0 THEN CAST(fp AS DOUBLE) / (n - support) ELSE 0.0 END AS fpr,
       ((CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END) + 1
        - (CASE WHEN n - support > 0 THEN CAST(fp AS DOUBLE) / (n - support) ELSE 0.0 END)) / 2 AS auc
FROM per, t
""",
    "ml_baseline_score_auc": BASE + """
, s AS (SELECT c.cls, b.score, CAST(b.label = c.cls AS INTEGER) AS y FROM b, (VALUES ('A'), ('N'), ('R')) c(cls))
, r AS (SELECT cls, y, rank() OVER (PARTITION BY cls ORDER BY score) AS rk,
               count(*) OVER (PARTITION BY cls, score) AS ties FROM s)
, g AS (SELECT cls, sum(y) AS n_pos, sum(1 - y) AS n_neg, sum(CASE WHEN y = 1 THEN rk + (ties - 1) / 2.0 END) AS rs
        FROM r GROUP BY 1)
SELECT cls, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
       (rs - n_pos * (n_pos + 1) / 2.0) / (CAST(n_pos AS DOUBLE) * n_neg) AS auc
FROM g
""",
    "ml_baseline_roc_curve": SEGMENTS + "SELECT cls, score AS threshold, tpr, fpr FROM seg",
    "ml_baseline_macro_roc": SEGMENTS + """
, g AS (SELECT cls, i, max(CASE WHEN fpr > fpr0
                                THEN tpr0 + (CAST(i AS DOUBLE) / 99 - fpr0) * ((tpr - tpr0) / (fpr - fpr0)) ELSE tpr END) AS t
        FROM seg, range(100) r(i) WHERE i >= ceil(fpr0 * 99) AND i <= floor(fpr * 99) GROUP BY 1, 2)
SELECT CAST(i AS DOUBLE) / 99 AS fpr, avg(t) AS macro_tpr FROM g GROUP BY i
""",
}
