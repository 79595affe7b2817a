"""Forward stepwise logistic regression from blocked aggregates.

Every scan of the data is one aggregate: gradient and information matrix of the log
likelihood over the intercept and *all* candidate features, at the current
coefficients.  The chosen features' block gives the Newton step of the refit; at
convergence the same numbers give the score statistic of every candidate,
``U_j^2 / (I_jj - I_jS I_SS^-1 I_Sj)``, so candidates cost no scan of their own and no
model is fitted per candidate.  The candidate with the largest statistic joins; the
selection ends when its refit does not lower the AIC.

What reaches the driver is (features + 1)^2 numbers per scan.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_STEPS, TOLERANCE = 50, 1e-10
#: Linear predictors beyond this are as good as certain; it keeps separated data finite.
MOST_LOGIT = 30.0


def _scaled(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """``y`` and standardised ``z0..`` (a constant feature is 0); the AIC does not depend on the scale."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)], *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    z = []
    for i, c in enumerate(features):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        z.append(((F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)).alias(f"z{i}"))
    return df.select(F.col(label).cast("double").alias("y"), *z)


def _scan(data: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood, gradient and information over intercept and all features at ``beta``."""
    k = len(beta)
    x = [F.lit(1.0), *[F.col(f"z{i}") for i in range(k - 1)]]
    eta = sum((F.lit(float(b)) * v for b, v in zip(beta, x) if b), F.lit(0.0))
    eta = F.greatest(F.least(eta, F.lit(MOST_LOGIT)), F.lit(-MOST_LOGIT))
    rows = data.select("*", eta.alias("eta")).select("*", (1 / (1 + F.exp(-F.col("eta")))).alias("p"))
    rest, weight = F.col("y") - F.col("p"), F.col("p") * (1 - F.col("p"))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    one = rows.agg(
        F.sum(F.col("y") * F.col("eta") - F.log1p(F.exp(F.col("eta")))).alias("ll"),
        *[F.sum(rest * x[i]).alias(f"g{i}") for i in range(k)],
        *[F.sum(weight * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in pairs],
    ).first()
    info = np.zeros((k, k))
    for i, j in pairs:
        info[i, j] = info[j, i] = one[f"h{i}_{j}"]
    return float(one["ll"]), np.array([one[f"g{i}"] for i in range(k)]), info


def _refit(data: DataFrame, beta: np.ndarray, chosen: list[int]) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Newton's method on the chosen coefficients (0 is the intercept); the scan that finds them converged also serves the scores."""
    last = None
    for _ in range(MOST_STEPS):
        ll, grad, info = _scan(data, beta)
        if last is not None and abs(ll - last) <= TOLERANCE * (abs(ll) + TOLERANCE):
            break
        last = ll
        block = info[np.ix_(chosen, chosen)]
        beta = beta.copy()
        beta[chosen] += np.linalg.lstsq(block, grad[chosen], rcond=None)[0]
    return beta, ll, grad, info


def score_statistics(grad: np.ndarray, info: np.ndarray, chosen: list[int]) -> dict[int, float]:
    """Per candidate its score statistic; 0 for one that the chosen features determine."""
    inverse = np.linalg.pinv(info[np.ix_(chosen, chosen)])
    out = {}
    for j in range(len(grad)):
        if j in chosen:
            continue
        cross = info[j, chosen]
        left = info[j, j] - cross @ inverse @ cross
        out[j] = float(grad[j] ** 2 / left) if left > 1e-9 * max(info[j, j], 1e-300) else 0.0
    return out


def forward(df: DataFrame, label: str, features: Sequence[str]) -> list[tuple[int, str | None, float, float | None]]:
    """``(step, added feature, AIC, score statistic)``, beginning with the intercept alone. Rows with a NULL are left out."""
    data = _scaled(df.select(label, *features).na.drop(), label, features)
    chosen, beta = [0], np.zeros(len(features) + 1)
    beta, ll, grad, info = _refit(data, beta, chosen)
    best = -2 * ll + 2
    path: list[tuple[int, str | None, float, float | None]] = [(0, None, best, None)]
    while len(chosen) <= len(features):
        scores = score_statistics(grad, info, chosen)
        j = max(scores, key=lambda i: (scores[i], -i))
        if scores[j] <= 0:
            break
        trial = [*chosen, j]
        new = _refit(data, beta, trial)
        aic = -2 * new[1] + 2 * len(trial)
        if aic >= best:
            break
        chosen, best, (beta, ll, grad, info) = trial, aic, new
        path.append((len(chosen) - 1, features[j - 1], aic, scores[j]))
    return path
