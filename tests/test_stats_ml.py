"""Statistics and modelling: hand-computed values, closed-form identities, brute
force on small fixtures and invariants (SURVEY 5.2 items 3 and 4)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.functions.distributions import chi2_sf, f_sf, norm_ppf, t_two_sided_p
from ledgerline.operators.ml import (
    classification_report,
    group_row_index,
    hard_label_auc,
    roc_auc,
    stratified_folds,
    stratified_split,
    uniform_hash,
)
from ledgerline.operators.profile import box_stats, describe, duplicate_rows
from ledgerline.operators.smote import nearest_neighbours, smote
from ledgerline.operators.stats import (
    canonical_scores,
    cca,
    chi_square_independence,
    hotelling_t2,
    lda_fit,
    lda_predict,
    two_sample,
)
from ledgerline.functions.columns import bin_left_closed, bin_right_closed

A = [1.0, 2.0, 3.0, 4.0, 5.0]
B = [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]


def test_distribution_table_values():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert f_sf(3.0, 2, 20) == pytest.approx(1.3**-10, rel=1e-10)
    assert chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert norm_ppf(0.975) == pytest.approx(1.959964, abs=1e-6)


def test_welch_pooled_and_cohens_d(spark):
    df = spark.createDataFrame([("a", x) for x in A] + [("b", x) for x in B], "arm string, x double")
    r = two_sample(df, "arm", ("a", "b"), "x").first()
    # by hand: mean 3 vs 7, var 2.5 vs 14, n 5 vs 6
    se2 = 2.5 / 5 + 14 / 6
    assert r.mean_diff == pytest.approx(4.0)
    assert r.t_welch == pytest.approx(4 / math.sqrt(se2))
    assert r.df_welch == pytest.approx(se2**2 / ((2.5 / 5) ** 2 / 4 + (14 / 6) ** 2 / 5))
    sp = (4 * 2.5 + 5 * 14) / 9
    assert r.t_pooled == pytest.approx(4 / math.sqrt(sp * (1 / 5 + 1 / 6)))
    assert r.cohens_d == pytest.approx(4 / math.sqrt(sp))


def test_hotelling_p1_equals_pooled_t_squared(spark):
    df = spark.createDataFrame([(0, x) for x in A] + [(1, x) for x in B], "g int, x double")
    h = hotelling_t2(df, "g", (0, 1), ["x"]).first()
    t = two_sample(df.withColumn("arm", F.col("g").cast("string")), "arm", ("0", "1"), "x").first().t_pooled
    assert h.t2 == pytest.approx(t * t)
    assert h.p_value == pytest.approx(t_two_sided_p(t, 9), rel=1e-9)


def test_cca_first_correlation_equals_score_correlation(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = np.column_stack([x[:, 0] + rng.normal(size=200), rng.normal(size=200), x[:, 1] * 0.5 + rng.normal(size=200)])
    rows = [tuple(map(float, np.concatenate([a, b]))) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, y1 double, y2 double, y3 double")
    fit = cca(df, ["x1", "x2"], ["y1", "y2", "y3"])
    s = canonical_scores(df, ["x1", "x2"], ["y1", "y2", "y3"], fit).agg(F.corr("eta", "psi")).first()[0]
    assert s == pytest.approx(fit["cor"][0], abs=1e-9)
    # brute force: largest canonical correlation from numpy on the same data
    c = np.cov(np.column_stack([x, y]).T)
    sxx, syy, sxy = c[:2, :2], c[2:, 2:], c[:2, 2:]
    m = np.linalg.solve(sxx, sxy) @ np.linalg.solve(syy, sxy.T)
    assert fit["cor"][0] == pytest.approx(math.sqrt(max(np.linalg.eigvals(m).real)), abs=1e-9)


def test_chi_square_matches_hand_computation(spark):
    cells = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30}  # (b, y) never observed
    rows = [k for k, n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "p string, q string")
    r = chi_square_independence(df, "p", "q").first()
    n = 60
    ra, cb = {"a": 30, "b": 30}, {"x": 40, "y": 20}
    expect = sum((cells.get((i, j), 0) - ra[i] * cb[j] / n) ** 2 / (ra[i] * cb[j] / n) for i in ra for j in cb)
    assert r.chi2 == pytest.approx(expect) and r.dof == 1 and r.n == 60


def test_lda_separates_planted_classes(spark):
    rng = np.random.default_rng(1)
    rows = [(0, float(a), float(b)) for a, b in rng.normal(0, 1, size=(100, 2))]
    rows += [(1, float(a) + 4, float(b) + 4) for a, b in rng.normal(0, 1, size=(100, 2))]
    df = spark.createDataFrame(rows, "label int, f1 double, f2 double")
    model = lda_fit(df, "label", ["f1", "f2"])
    acc = lda_predict(df, ["f1", "f2"], model).agg(F.avg((F.col("label") == F.col("prediction")).cast("double")))
    assert acc.first()[0] > 0.97


def test_report_and_hard_auc(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 1)]  # class 2 never predicted (0/0 -> 0)
    df = spark.createDataFrame(pairs, "label int, prediction int")
    rep = {r.cls: r for r in classification_report(df).collect()}
    assert rep["0"].precision == 1.0 and rep["0"].recall == 0.75
    assert rep["1"].precision == pytest.approx(0.5) and rep["1"].recall == 1.0
    assert rep["2"].precision == 0.0 and rep["2"].f1 == 0.0 and rep["2"].support == 1
    assert rep["accuracy"].precision == pytest.approx(5 / 7)
    assert rep["macro avg"].recall == pytest.approx((0.75 + 1 + 0) / 3)
    auc = {r.cls: r for r in hard_label_auc(df).collect()}
    assert auc["0"].auc == pytest.approx((0.75 + 1 - 0.0) / 2)
    assert auc["1"].auc == pytest.approx((1.0 + 1 - 2 / 5) / 2)


def test_auc_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(2)
    s = np.round(rng.uniform(size=300), 2)  # many ties
    y = (rng.uniform(size=300) < s).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    got = roc_auc(df, F.col("y") == 1, F.col("s")).first().auc
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert got == pytest.approx(brute, abs=1e-12)


def test_group_row_index_is_exact_permutation(spark):
    df = spark.range(0, 5000).withColumn("g", (F.col("id") % 3 == 0).cast("int"))
    d = df.withColumn("_u", uniform_hash(["id"], 7))
    out = group_row_index(d, ["g"], "_u", buckets=32).groupBy("g").agg(
        F.count("*").alias("n"), F.min("_idx").alias("lo"), F.max("_idx").alias("hi"),
        F.count_distinct("_idx").alias("k")).collect()
    for r in out:
        assert r.lo == 0 and r.hi == r.n - 1 and r.k == r.n


def test_stratified_split_and_folds(spark):
    df = spark.range(0, 1000).withColumn("label", F.when(F.col("id") < 100, 1).otherwise(0))
    s = stratified_split(df, "label", ["id"], 0.2, 42)
    counts = {(r.label, r.is_test): r["count"] for r in s.groupBy("label", "is_test").count().collect()}
    assert counts[(1, True)] == 20 and counts[(0, True)] == 180
    again = stratified_split(df, "label", ["id"], 0.2, 42).filter("is_test").select("id")
    assert again.exceptAll(s.filter("is_test").select("id")).count() == 0  # repeatable
    f = stratified_folds(df, "label", ["id"], 5, 42)
    per = f.groupBy("fold", "label").count().collect()
    assert {r["count"] for r in per if r.label == 1} == {20}
    assert f.count() == 1000


def test_smote_neighbours_exact_and_invariants(spark):
    rng = np.random.default_rng(3)
    pts = {0: rng.normal(size=(60, 3)), 1: rng.normal(size=(14, 3)) + 2, 2: rng.normal(size=(1, 3))}
    rows = [(f"{c}-{i}", float(c), [float(v) for v in p]) for c, arr in pts.items() for i, p in enumerate(arr)]
    df = spark.createDataFrame(rows, "id string, label double, f array<double>")
    nn = {r.id: r.nn_ids for r in nearest_neighbours(df.filter("label = 1"), "label", "id", "f", k=5).collect()}
    arr = pts[1]
    for i in range(len(arr)):
        d = np.linalg.norm(arr - arr[i], axis=1)
        d[i] = np.inf
        assert nn[f"1-{i}"] == [f"1-{j}" for j in np.argsort(d, kind="stable")[:5]]
    out = smote(df, "label", "id", "f", k=5, seed=1)
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0.0: 60, 1.0: 60, 2.0: 60}
    assert out.filter(~F.col("synthetic")).count() == 75  # every original row kept
    # synthetic points of class 1 lie on a segment between two class-1 points
    src = {f"1-{i}": p for i, p in enumerate(arr)}
    for r in out.filter("synthetic AND label = 1").collect():
        x = src[r.id.split("#")[0]]
        v = np.array(r.f) - x
        ok = any(np.allclose(np.cross(v, src[n] - x), 0, atol=1e-9) and np.dot(v, src[n] - x) >= -1e-12
                 for n in nn[r.id.split("#")[0]])
        assert ok
    # the single-row class is duplicated
    assert {tuple(r.f) for r in out.filter("label = 2").collect()} == {tuple(pts[2][0])}


def test_profile_helpers(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (3, "b")], "k int, v string")
    d = duplicate_rows(df).first()
    assert d.n_rows == 4 and d.n_duplicates == 1  # NULL equals NULL
    q = describe(df, ["k"]).first()
    assert (q.p25, q.p50, q.p75) == (1.0, 1.5, 2.25)
    b = box_stats(spark.createDataFrame([("g", float(x)) for x in [1, 2, 3, 4, 100]], "g string, x double"),
                  "x", ["g"]).first()
    assert b.n_outliers == 1 and b.whisker_high == 4.0


def test_bin_edges(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 3.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0, -1.0, None]],
                               "x double")
    left = bin_left_closed("x", [0, 3, 10, 20, 50, float("inf")], ["0-3", "4-10", "11-20", "21-50", ">50"])
    right = bin_right_closed("x", [0, 100, 200, 500, float("inf")], ["0-100", "101-200", "201-500", ">500"])
    got = [(r[0], r[1]) for r in df.select(left, right).collect()]
    assert got == [("0-3", None), ("4-10", "0-100"), ("11-20", "0-100"), ("21-50", "0-100"), (">50", "0-100"),
                   (">50", "0-100"), (">50", "101-200"), (">50", "201-500"), (None, None), (None, None)]
