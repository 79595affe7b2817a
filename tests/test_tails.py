"""Native tail probabilities against the scalar functions and closed forms."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import distributions as D
from ledgerline.functions import tails as T


def test_t_f_chi2_normal_against_scalars(spark):
    ts = [(t, float(df)) for t in (0.0, 0.3, -1.7, 2.5, 8.0, 30.0) for df in (1, 2.5, 9, 120, 4321, 90000, 150000, 4_000_000)]
    got = spark.createDataFrame(ts, "t double, df double").select("t", "df", T.t_p_value("t", "df").alias("p")).collect()
    for r in got:
        if r.df < 1e6:
            assert r.p == pytest.approx(D.t_two_sided_p(r.t, r.df), rel=2e-8, abs=1e-300), r
        elif abs(r.t) < 3:  # the normal distribution, but for terms of t^4 / df
            assert r.p == pytest.approx(math.erfc(abs(r.t) / math.sqrt(2)), rel=1e-5), r
    fs = [(f, float(a), float(b)) for f in (0.0, 0.2, 1.0, 3.3, 40.0) for a in (1, 2, 7) for b in (3, 20, 997, 59997)]
    for r in spark.createDataFrame(fs, "f double, a double, b double").select("f", "a", "b", T.f_p_value("f", "a", "b").alias("p")).collect():
        assert r.p == pytest.approx(D.f_sf(r.f, r.a, r.b), rel=1e-8, abs=1e-300), r
        if r.a == 2:
            assert r.p == pytest.approx((1 + 2 * r.f / r.b) ** (-r.b / 2), rel=1e-8)
    cs = [(x, float(k)) for x in (0.0, 0.5, 3.0, 25.0, 400.0) for k in (1, 2, 5, 30, 200)]
    for r in spark.createDataFrame(cs, "x double, k double").select("x", "k", T.chi2_p_value("x", "k").alias("p")).collect():
        assert r.p == pytest.approx(D.chi2_sf(r.x, r.k), rel=1e-9, abs=1e-300), r
    zs = [(z,) for z in (-37.0, -6.0, -1.96, 0.0, 0.4, 5.0)]
    for r in spark.createDataFrame(zs, "z double").select("z", T.normal_cdf("z").alias("p")).collect():
        assert r.p == pytest.approx(D.norm_cdf(r.z), rel=1e-9)


def test_undefined_arguments_are_null(spark):
    rows = [(None, 3.0), (1.0, None), (float("nan"), 3.0), (1.0, 0.0), (float("inf"), 2.0)]
    got = spark.createDataFrame(rows, "t double, df double").select(T.t_p_value("t", "df").alias("p"), T.chi2_p_value("t", "df").alias("c")).collect()
    assert [r.p for r in got] == [None] * 5 and [r.c for r in got] == [None] * 5


def test_ln_gamma_and_ln_beta(spark):
    for x in (0.5, 1.0, 3.7, 50.0, 1e6):
        assert spark.range(1).select(T.ln_gamma(F.lit(x))).first()[0] == pytest.approx(math.lgamma(x), rel=1e-13, abs=1e-13)
    got = spark.range(1).select(T.ln_beta(F.lit(30000.0), F.lit(1.0))).first()[0]
    assert got == pytest.approx(-math.log(30000.0), rel=1e-14)
