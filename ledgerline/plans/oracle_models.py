"""DuckDB oracle SQL for canonical correlations (IN3) and the discriminant analysis (IN5).

Linear systems are solved by Gauss-Jordan steps, one CTE per pivot; the matrices are covariances, so the
diagonal serves as pivots.
"""

from __future__ import annotations

from ledgerline.plans.oracle import _with
from ledgerline.plans.oracle_stats import CLAIMS

X = ["Female", "Age"]
Y = ["Foreign_factor", "Engine_Capacity", "Vehicle_Age", "Car_Value"]
LDA = ["Female", "Age", "Engine_Capacity", "Vehicle_Age", "Car_Value", "Foreign_factor"]


def solved(name: str, source: str, n: int, m: int, keep: list[str]) -> str:
    """CTEs that end in ``name``: ``source`` has a0_0.. (n x n) and b0_0.. (n x m); the solution is in b0_0... ``keep``: other columns."""
    steps = []
    at = source
    for k in range(n):
        out = name if k == n - 1 else f"{name}_{k}"
        cells = []
        for i in range(n):
            for c, width in (("a", n), ("b", m)):
                for j in range(width):
                    pivot = f"{c}{k}_{j} / a{k}_{k}"
                    cells.append(f"{pivot if i == k else f'{c}{i}_{j} - a{i}_{k} * ({pivot})'} AS {c}{i}_{j}")
        steps.append(f"{out} AS (SELECT {', '.join([*keep, *cells])} FROM {at})")
        at = out
    return ",\n".join(steps)


def _cov(a: str, b: str) -> str:
    return f"covar_samp(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


_MOMENTS = [f"{_cov(a, b)} AS x{i}_{j}" for i, a in enumerate(X) for j, b in enumerate(X)]
_MOMENTS += [f"{_cov(a, b)} AS a{i}_{j}" for i, a in enumerate(Y) for j, b in enumerate(Y)]
_MOMENTS += [f"{_cov(a, b)} AS b{i}_{j}" for i, a in enumerate(Y) for j, b in enumerate(X)]
_MOMENTS += [f"{_cov(a, b)} AS c{i}_{j}" for i, a in enumerate(Y) for j, b in enumerate(X)]
_MOMENTS += [f"{_cov(a, a)} AS v{i}" for i, a in enumerate(Y)]
_KEEP = ["n", *[f"x{i}_{j}" for i in range(2) for j in range(2)], *[f"c{i}_{j}" for i in range(4) for j in range(2)], *[f"v{i}" for i in range(4)]]

# b: Syy^-1 Syx; m: Sxy Syy^-1 Syx; l: the Cholesky factor of Sxx; s: l^-1 m l^-T, symmetric, its axes at an angle
CCA = _with(CLAIMS) + ", cov AS (SELECT count(*) AS n, " + ", ".join(_MOMENTS) + " FROM claims_f),\n" + solved("ys", "cov", 4, 2, _KEEP) + """,
mm AS (SELECT *, """ + ", ".join(f"{' + '.join(f'c{k}_{i} * b{k}_{j}' for k in range(4))} AS m{i}_{j}" for i in range(2) for j in range(2)) + """ FROM ys),
ll AS (SELECT *, sqrt(x0_0) AS l00, x1_0 / sqrt(x0_0) AS l10, sqrt(x1_1 - x1_0 * x1_0 / x0_0) AS l11 FROM mm),
tt AS (SELECT *, m0_0 / l00 AS t00, m0_1 / l00 AS t01, (m1_0 - l10 * m0_0 / l00) / l11 AS t10, (m1_1 - l10 * m0_1 / l00) / l11 AS t11 FROM ll),
ss AS (SELECT *, t00 / l00 AS s00, (t01 - l10 * t00 / l00) / l11 AS s01, (t11 - l10 * t10 / l00) / l11 AS s11 FROM tt),
l1 AS (SELECT *, (s00 + s11) / 2 + sqrt((s00 - s11) * (s00 - s11) / 4 + s01 * s01) AS ev1, atan2(2 * s01, s00 - s11) / 2 AS angle FROM ss),
l2 AS (SELECT *, (s00 * s11 - s01 * s01) / ev1 AS ev2 FROM l1),
pairs AS (SELECT *, 1 AS component, ev1 AS ev, cos(angle) AS e0, sin(angle) AS e1 FROM l2 UNION ALL SELECT *, 2, ev2, -sin(angle), cos(angle) FROM l2),
raw AS (SELECT *, (e0 - l10 * e1 / l11) / l00 AS r0, e1 / l11 AS r1 FROM pairs),
unit AS (SELECT *, CASE WHEN abs(r0) >= abs(r1) THEN sign(r0) ELSE sign(r1) END AS size FROM raw),
fit AS (SELECT *, r0 / size AS w0, r1 / size AS w1, sqrt(ev) AS rho FROM unit)
"""


def _coefficients() -> str:
    out = []
    for i, v in enumerate(X):
        out.append(f"SELECT component, 'x' AS side, '{v}' AS variable, w{i} AS coefficient, (x{i}_0 * w0 + x{i}_1 * w1) / sqrt(x{i}_{i}) AS loading FROM fit")
    for i, v in enumerate(Y):
        own = f"(b{i}_0 * w0 + b{i}_1 * w1) / rho"  # Syy^-1 Syx a / rho; times Syy again: Syx a / rho
        out.append(f"SELECT component, 'y', '{v}', {own}, (c{i}_0 * w0 + c{i}_1 * w1) / rho / sqrt(v{i}) FROM fit")
    return "\nUNION ALL\n".join(out)


_P = len(LDA)
_CLASS = [f"avg(CAST({c} AS DOUBLE)) AS mu{i}" for i, c in enumerate(LDA)] + [f"{_cov(a, b)} AS s{i}_{j}" for i, a in enumerate(LDA) for j, b in enumerate(LDA)]
_POOLED = [f"((k0.n - 1) * k0.s{i}_{j} + (k1.n - 1) * k1.s{i}_{j}) / (k0.n + k1.n - 2) AS a{i}_{j}" for i in range(_P) for j in range(_P)]
_MEANS = [f"k{k}.mu{i} AS b{i}_{k}" for i in range(_P) for k in range(2)] + [f"k{k}.mu{i} AS mu{k}_{i}" for i in range(_P) for k in range(2)]
_LDA_KEEP = ["n0", "n1", *[f"mu{k}_{i}" for i in range(_P) for k in range(2)]]


def _score(k: int) -> str:
    linear = " + ".join(f"b{i}_{k} * CAST({c} AS DOUBLE)" for i, c in enumerate(LDA))
    return f"{linear} - 0.5 * ({' + '.join(f'mu{k}_{i} * b{i}_{k}' for i in range(_P))}) + ln(CAST(n{k} AS DOUBLE) / (n0 + n1))"


PREDICTED = _with(CLAIMS) + """
, marked AS (SELECT *, Claim_Amount_Indicator AS label, row_number() OVER (PARTITION BY claim_order, claim_line, claim_part
                                       ORDER BY Claim_Amount_Indicator, Claim_Amount, """ + ", ".join(LDA) + """) AS copy FROM claims_f)
, drawn AS (SELECT *, row_number() OVER (ORDER BY CAST('0x' || substr(md5(concat_ws('|', claim_order, claim_line, claim_part, copy, 2)), 1, 13) AS BIGINT),
                                                  claim_order, claim_line, claim_part, copy) AS place FROM marked)
, stats AS (SELECT label, count(*) AS n, """ + ", ".join(_CLASS) + """ FROM drawn WHERE place > 1000 GROUP BY 1)
, pooled AS (SELECT k0.n AS n0, k1.n AS n1, """ + ", ".join([*_POOLED, *_MEANS]) + """
             FROM (SELECT * FROM stats WHERE label = 0) k0, (SELECT * FROM stats WHERE label = 1) k1),
""" + solved("weights", "pooled", _P, 2, _LDA_KEEP) + f"""
, scored AS (SELECT label, {_score(0)} AS score0, {_score(1)} AS score1 FROM drawn, weights WHERE place <= 1000)
, predicted AS (SELECT label, CASE WHEN score1 >= score0 THEN 1 ELSE 0 END AS prediction FROM scored)
"""

MODELS_SQL: dict[str, str] = {
    "in3_cca_correlations": CCA + "SELECT component, rho AS canonical_corr FROM fit",
    "in3_cca_coefficients": CCA + _coefficients(),
    "in3_cca_score_correlation": CCA + "SELECT rho AS corr_eta_psi, n FROM fit WHERE component = 1",
    "in5_lda_confusion": PREDICTED + "SELECT label, prediction, count(*) AS count FROM predicted GROUP BY 1, 2",
    "in5_lda_accuracy": PREDICTED + "SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n_test FROM predicted",
}
