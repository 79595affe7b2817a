"""NULL keys, balanced classes, gaps between periods, and exact curves."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import order_stats
from ledgerline.operators.impact import period_totals
from ledgerline.operators.ml import macro_roc, roc_auc, roc_curve, stratified_split
from ledgerline.operators.profile import box_stats, describe
from ledgerline.operators.share import with_total
from ledgerline.operators.smote import smote


def test_null_group_keeps_its_statistics(spark):
    rows = [(None, 1.0), (None, 2.0), (None, 3.0), ("a", 1.0), ("a", 1.0), ("a", 1.0), ("a", 1.0), ("a", 100.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    box = {r.g: r for r in box_stats(df, "x", ["g"]).collect()}
    assert set(box) == {None, "a"}
    assert (box[None].q1, box[None].median, box[None].q3, box[None].n_outliers) == (1.5, 2.0, 2.5, 0)
    assert (box["a"].n, box["a"].n_outliers, box["a"].whisker_high) == (5, 1, 1.0)
    quart = {r.g: (r.p25, r.p50, r.p75) for r in describe(df, ["x"], by=["g"]).collect()}
    assert quart[None] == (1.5, 2.0, 2.5)


def test_split_keeps_rows_without_a_label(spark):
    df = spark.range(15).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3).alias("label"))
    out = stratified_split(df, "label", ["id"], 0.2).collect()
    assert sorted(r.id for r in out) == list(range(15))
    assert sum(r.is_test for r in out if r.label is None) == 1


def test_balanced_and_empty_input_of_smote(spark):
    df = spark.createDataFrame([(i, i % 2, [float(i), 1.0]) for i in range(6)], "id int, label int, f array<double>")
    assert [r.synthetic for r in smote(df, "label", "id", "f").collect()] == [False] * 6
    assert smote(df.limit(0), "label", "id", "f").count() == 0


def test_periods_between_the_windows_are_left_out(spark):
    df = spark.createDataFrame([(w, 10) for w in range(1, 53)], "week_number int, sales long")
    out = period_totals(df, before=(13, 20), after=(25, 36)).collect()
    assert [(r.time_period, r.total_sales, r.prev_total_sales) for r in out] == [("before", 80.0, None), ("after", 120.0, 80.0)]


@pytest.mark.parametrize("ranges", [1, 4, 256])
def test_roc_curve_against_brute_force(spark, monkeypatch, ranges):
    monkeypatch.setattr(order_stats, "RANGES", ranges)
    rng = np.random.default_rng(5)
    data = [(c, float(s), int(y)) for c in "ab" for s, y in zip(rng.integers(0, 12, 60) / 12, rng.integers(0, 2, 60))]
    data.append(("a", 1e9, 1))  # far from the others
    df = spark.createDataFrame(data, "c string, s double, y int")
    args = (df, F.col("y") == 1, F.col("s"), ["c"])
    got = {(r.c, r.threshold): (r.tpr, r.fpr) for r in roc_curve(*args).collect()}
    area = {r.c: r.auc for r in roc_auc(*args).collect()}
    grid, curves = np.linspace(0, 1, 100), []
    for c in "ab":
        s, y = (np.array(v) for v in zip(*[(s, y) for k, s, y in data if k == c]))
        points = [((y[s >= t] == 1).sum() / (y == 1).sum(), (y[s >= t] == 0).sum() / (y == 0).sum()) for t in sorted(set(s), reverse=True)]
        for t, p in zip(sorted(set(s), reverse=True), points):
            assert got.pop((c, t)) == pytest.approx(p)
        pos, neg = s[y == 1][:, None], s[y == 0][None, :]
        assert area[c] == pytest.approx(((pos > neg) + 0.5 * (pos == neg)).mean())
        tpr, fpr = (np.array([0.0, *v]) for v in zip(*points))
        curves.append(np.interp(grid, fpr, tpr))
    assert not got
    macro = sorted((r.fpr, r.macro_tpr) for r in macro_roc(*args).collect())
    assert [f for f, _ in macro] == pytest.approx(grid)
    assert [t for _, t in macro] == pytest.approx(np.mean(curves, axis=0))


def test_total_within_a_null_group(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("x", "a", 4)], "g string, k string, n long")
    assert {(r.g, r.k): r["_total"] for r in with_total(df, "n", within=["g"]).collect()} == {(None, "a"): 3, (None, "b"): 3, ("x", "a"): 4}
