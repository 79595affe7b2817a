"""Two-sample and multivariate statistics.

The heavy part of every test is one Spark aggregate -- counts, means, variances or
the sums and cross-products of the columns, per group.  What reaches the driver is
at most a p x p moment matrix per group (p = number of variables), where numpy
solves, inverts or takes eigenvectors; nothing row-level is ever collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.distributions import norm_ppf
from ledgerline.functions.tails import chi2_p_value, f_p_value, normal_cdf, t_p_value


# --------------------------------------------------------------------------- pairwise moments

def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (incl. the diagonal), one aggregate, long format."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"`{a}__{b}`").alias("corr"))
        for a, b in pairs
    ]))
    return one.select(rows.alias("_s")).select("_s.*")


def cov_by_group(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Sample covariance matrix per group, long format ``by..., var_a, var_b, cov``."""
    pairs = list(combinations_with_replacement(cols, 2))
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.covar_samp(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs],
    )
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"`{a}__{b}`").alias("cov"))
        for a, b in pairs
    ]))
    return g.select(*by, "n", rows.alias("_s")).select(*by, "n", "_s.*")


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """``scale(x)``: ``(x - mean) / sample sd`` per column (P20); the means and sds are
    one aggregate, joined back as a one-row broadcast."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    j = df.withColumn("_one", F.lit(1)).join(F.broadcast(stats.withColumn("_one", F.lit(1))), "_one")
    j = j.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}") for c in cols})
    return j.drop("_one", *[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def cov_matrix(df: DataFrame, cols: Sequence[str], by: str | None = None) -> dict:
    """``{group: (n, mean, cov)}`` with ``covar_samp`` / ``avg`` (stable) in one aggregate."""
    pairs = list(combinations_with_replacement(cols, 2))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(F.col(c).cast("double")).alias(f"m__{c}") for c in cols]
    aggs += [F.covar_samp(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c__{a}__{b}") for a, b in pairs]
    g = df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)
    out = {}
    p = len(cols)
    for row in g.collect():  # one row per group: p x p numbers each
        cov = np.zeros((p, p))
        for i, a in enumerate(cols):
            for j in range(i, p):
                cov[i, j] = cov[j, i] = row[f"c__{a}__{cols[j]}"]
        key = row[by] if by else None
        out[key] = (int(row["n"]), np.array([row[f"m__{c}"] for c in cols], dtype=float), cov)
    return out


# --------------------------------------------------------------------------- two-sample tests

def two_sample(df: DataFrame, arm_col: str, arms: tuple, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Welch and pooled t statistics, Welch-Satterthwaite df and Cohen's d per group
    (T1, T2, T6).  ``mean_diff = mean(arm b) - mean(arm a)``.

    One ``groupBy(by, arm)`` aggregate of count / mean / sample variance, then the
    two arms side by side per group (a conditional re-aggregate on the tiny result).
    """
    a, b = arms
    x = F.col(value).cast("double")
    per_arm = df.filter(F.col(arm_col).isin(a, b)).groupBy(*by, arm_col).agg(
        F.count(x).alias("n"), F.avg(x).alias("m"), F.var_samp(x).alias("v")
    )

    def pick(arm, c):
        return F.max(F.when(F.col(arm_col) == arm, F.col(c)))

    side = per_arm.groupBy(*by).agg(
        pick(a, "n").alias("n_a"), pick(b, "n").alias("n_b"),
        pick(a, "m").alias("mean_a"), pick(b, "m").alias("mean_b"),
        pick(a, "v").alias("var_a"), pick(b, "v").alias("var_b"),
    ) if by else per_arm.agg(
        pick(a, "n").alias("n_a"), pick(b, "n").alias("n_b"),
        pick(a, "m").alias("mean_a"), pick(b, "m").alias("mean_b"),
        pick(a, "v").alias("var_a"), pick(b, "v").alias("var_b"),
    )
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    va, vb = F.col("var_a"), F.col("var_b")
    se2 = va / na + vb / nb
    diff = F.col("mean_b") - F.col("mean_a")
    pooled_var = ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
    return side.select(
        *by, "n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b",
        diff.alias("mean_diff"),
        (diff / F.sqrt(se2)).alias("t_welch"),
        (se2 * se2 / ((va / na) * (va / na) / (na - 1) + (vb / nb) * (vb / nb) / (nb - 1))).alias("df_welch"),
        (diff / F.sqrt(pooled_var * (1 / na + 1 / nb))).alias("t_pooled"),
        (na + nb - 2).alias("df_pooled"),
        (diff / F.sqrt(pooled_var)).alias("cohens_d"),
    )


def with_p_values_and_power(tests: DataFrame, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Adds two-sided p-values (Welch and pooled), achieved power of the observed
    effect at ``alpha`` (normal approximation) and the per-arm n for ``power`` (T1, T3).
    Native columns on the aggregated rows (one per group)."""
    z_a = norm_ppf(1 - alpha / 2)
    z_b = norm_ppf(power)
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    ncp = F.abs(F.col("cohens_d")) * F.sqrt(na * nb / (na + nb))
    return tests.select(
        "*",
        t_p_value(F.col("t_welch"), F.col("df_welch")).alias("p_welch"),
        t_p_value(F.col("t_pooled"), F.col("df_pooled")).alias("p_pooled"),
        normal_cdf(ncp - F.lit(z_a)).alias("achieved_power"),
        F.ceil(F.lit(2 * (z_a + z_b) ** 2) / (F.col("cohens_d") * F.col("cohens_d"))).alias("n_per_arm_needed"),
    )


def rate_difference(df: DataFrame, arm_col: str, arms: tuple, outcome: Column, cost: Column | None = None,
                    z: float = 1.959963984540054) -> DataFrame:
    """Outcome rate per arm, difference (b - a) with a normal-approximation CI, the
    sample-ratio chi-square against an even split, and total cost per arm (T4)."""
    a, b = arms
    g = df.filter(F.col(arm_col).isin(a, b)).agg(
        *[F.count_if(F.col(arm_col) == arm).alias(f"n_{k}") for k, arm in (("a", a), ("b", b))],
        *[F.count_if((F.col(arm_col) == arm) & outcome).alias(f"x_{k}") for k, arm in (("a", a), ("b", b))],
        *([F.sum(F.when(F.col(arm_col) == arm, cost)).alias(f"cost_{k}") for k, arm in (("a", a), ("b", b))]
          if cost is not None else []),
    )
    pa = F.col("x_a") / F.col("n_a")
    pb = F.col("x_b") / F.col("n_b")
    se = F.sqrt(pa * (1 - pa) / F.col("n_a") + pb * (1 - pb) / F.col("n_b"))
    tot = F.col("n_a") + F.col("n_b")
    srm = ((F.col("n_a") - tot / 2) ** 2 + (F.col("n_b") - tot / 2) ** 2) / (tot / 2)
    out = g.select(
        "*",
        pa.alias("rate_a"), pb.alias("rate_b"), (pb - pa).alias("rate_diff"),
        (pb - pa - z * se).alias("ci_low"), (pb - pa + z * se).alias("ci_high"),
        srm.alias("srm_chi2"),
    )
    return out


def chi_square_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-square of independence of two categoricals (T5).

    Contingency counts by one aggregate; row and column margins by two small
    aggregates of those counts joined back; cells never observed contribute
    ``E`` each (sum of all expected minus the expected of the observed cells).
    """
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    ra = cells.groupBy(a).agg(F.sum("o").alias("ra"))
    cb = cells.groupBy(b).agg(F.sum("o").alias("cb"))
    j = cells.join(ra, a).join(cb, b)
    tot = cells.agg(
        F.sum("o").alias("n"),
        F.count_distinct(F.col(a)).alias("r"),
        F.count_distinct(F.col(b)).alias("c"),
    ).withColumn("_one", F.lit(1))
    j = j.withColumn("_one", F.lit(1)).join(F.broadcast(tot), "_one")
    e = F.col("ra").cast("double") * F.col("cb") / F.col("n")
    s = j.groupBy("n", "r", "c").agg(
        F.sum((F.col("o") - e) ** 2 / e).alias("_obs_part"),
        F.sum(e).alias("_e_obs"),
    )
    # unobserved cells: O = 0, contribution (0 - E)^2 / E = E; all expected cells sum to n
    return s.select(
        (F.col("_obs_part") + (F.col("n") - F.col("_e_obs"))).alias("chi2"),
        ((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"),
        F.col("n").alias("n"),
    )


def with_chi2_p(df: DataFrame, stat: str = "chi2", dof: str = "dof") -> DataFrame:
    return df.withColumn("p_value", chi2_p_value(F.col(stat), F.col(dof).cast("double")))


# --------------------------------------------------------------------------- multivariate

def hotelling_t2(df: DataFrame, group_col: str, groups: tuple, cols: Sequence[str]) -> DataFrame:
    """Two-sample Hotelling T-squared with pooled covariance.

    ``T2 = n1 n2 / (n1 + n2) * d' Sp^-1 d``,
    ``F = (n1 + n2 - p - 1) / ((n1 + n2 - 2) p) * T2`` on (p, n1 + n2 - p - 1) df.
    Returns one row: n1, n2, t2, f, df1, df2, p_value.
    """
    spark: SparkSession = df.sparkSession
    stats = cov_matrix(df.filter(F.col(group_col).isin(*groups)), cols, by=group_col)
    (n1, m1, s1), (n2, m2, s2) = stats[groups[0]], stats[groups[1]]
    p = len(cols)
    sp = ((n1 - 1) * s1 + (n2 - 1) * s2) / (n1 + n2 - 2)
    d = m1 - m2
    t2 = float(n1 * n2 / (n1 + n2) * d @ np.linalg.solve(sp, d))
    df1, df2 = p, n1 + n2 - p - 1
    f = (n1 + n2 - p - 1) / ((n1 + n2 - 2) * p) * t2
    row = (n1, n2, t2, float(f), float(df1), float(df2))
    out = spark.createDataFrame([row], "n1 long, n2 long, t2 double, f double, df1 double, df2 double")
    return out.withColumn("p_value", f_p_value("f", "df1", "df2"))


def cca(df: DataFrame, xcols: Sequence[str], ycols: Sequence[str]) -> dict:
    """Canonical correlation analysis.

    One Spark aggregate gives the joint covariance; on the driver, scaled to correlations so that
    variables of very different size lose no digits: ``Sxx^-1/2 Sxy Syy^-1/2 = U D V'``; canonical correlations are ``D``;
    ``a = Sxx^-1/2 U``, ``b = Syy^-1/2 V`` so every variate has unit sample variance.
    Signs: the largest-magnitude x coefficient of each pair is positive.
    Structure coefficients (``corr(X, X a)``) come from the same moments.
    """
    cols = list(xcols) + list(ycols)
    (n, mean, cov), = cov_matrix(df, cols).values()
    p = len(xcols)
    sd = np.sqrt(np.diag(cov))
    r = cov / np.outer(sd, sd)
    sxx, syy, sxy = r[:p, :p], r[p:, p:], r[:p, p:]

    def inv_sqrt(m):
        w, v = np.linalg.eigh(m)
        return v @ np.diag(1.0 / np.sqrt(w)) @ v.T

    kx, ky = inv_sqrt(sxx), inv_sqrt(syy)
    u, d, vt = np.linalg.svd(kx @ sxy @ ky)
    k = min(len(xcols), len(ycols))
    a = kx @ u[:, :k] / sd[:p, None]
    b = ky @ vt.T[:, :k] / sd[p:, None]
    for j in range(k):
        if a[np.argmax(np.abs(a[:, j])), j] < 0:
            a[:, j] *= -1
            b[:, j] *= -1
    corr_x = sxx @ (a * sd[:p, None])
    corr_y = syy @ (b * sd[p:, None])
    return {"n": n, "mean": mean, "cor": d[:k], "xcoef": a, "ycoef": b, "corr_x": corr_x, "corr_y": corr_y}


def canonical_scores(df: DataFrame, xcols: Sequence[str], ycols: Sequence[str], fit: dict, k: int = 0) -> DataFrame:
    """Per-row canonical variates ``eta = (X - mean) a_k`` and ``psi = (Y - mean) b_k`` as
    column expressions (M22); ``corr(eta, psi)`` equals the k-th canonical correlation."""
    p = len(xcols)
    eta = sum(((F.col(c).cast("double") - float(fit["mean"][i])) * float(fit["xcoef"][i, k])
               for i, c in enumerate(xcols)), F.lit(0.0))
    psi = sum(((F.col(c).cast("double") - float(fit["mean"][p + i])) * float(fit["ycoef"][i, k])
               for i, c in enumerate(ycols)), F.lit(0.0))
    return df.withColumns({"eta": eta, "psi": psi})


def lda_fit(df: DataFrame, label: str, cols: Sequence[str]) -> dict:
    """Linear discriminant analysis (M24): class means, pooled covariance, priors =
    class shares; returns per-class linear score coefficients
    ``w_k = S^-1 mu_k`` and ``c_k = -1/2 mu_k' S^-1 mu_k + ln(pi_k)``."""
    stats = cov_matrix(df, cols, by=label)
    n = sum(v[0] for v in stats.values())
    k = len(stats)
    p = len(cols)
    pooled = sum((v[0] - 1) * v[2] for v in stats.values()) / (n - k)
    inv = np.linalg.inv(pooled.reshape(p, p))
    model = {}
    for cls, (nk, mu, _) in stats.items():
        w = inv @ mu
        model[cls] = (w, float(-0.5 * mu @ inv @ mu + math.log(nk / n)))
    return model


def lda_predict(df: DataFrame, cols: Sequence[str], model: dict, out: str = "prediction") -> DataFrame:
    """Scores every class as a column expression and takes the arg-max (no UDF)."""
    scores = []
    for cls, (w, c) in sorted(model.items()):
        s = sum((F.col(col).cast("double") * float(w[i]) for i, col in enumerate(cols)), F.lit(c))
        scores.append(F.struct(s.alias("score"), F.lit(cls).alias("cls")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return df.withColumn(out, best["cls"])
