"""Iterative fits read their input's steps once, not in every iteration."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import modelling as M


@pytest.fixture
def counted(spark):
    seen = spark.sparkContext.accumulator(0)

    def of(kind):
        def step(x):
            seen.add(1)
            return x

        return F.udf(step, kind)

    return seen, of


def test_odds_ratios(spark, monkeypatch, counted):
    seen, of = counted
    rows = [(i, float(i % 2 if i % 5 else (i + 1) % 2), *[float((i * (j + 3) + i // 7) % (11 + j)) for j in range(len(M.DOC_FEATURES))]) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, label double, " + ", ".join(f"{c} double" for c in M.DOC_FEATURES))
    monkeypatch.setattr(M, "doc_table", lambda s, d: frame.withColumn("n_chars", of("double")("n_chars")))
    assert M.t8_odds_ratios(spark, "x").count() == len(M.DOC_FEATURES) + 1
    assert seen.value == 200


def test_comparison_reads_its_topics_once(spark, monkeypatch, counted):
    seen, of = counted
    rows = [(i, float(i % 3 == 0), *[float((i * (j + 3) + i // 7) % (11 + j)) for j in range(len(M.DOC_FEATURES))]) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, label double, " + ", ".join(f"{c} double" for c in M.DOC_FEATURES))
    topics = spark.createDataFrame([(i, [0.25, 0.75] if i % 2 else [0.5, 0.5]) for i in range(100)], "doc_id long, t array<double>")
    topics = topics.select("doc_id", M.array_to_vector(of("array<double>")("t")).alias("topicDistribution"))
    monkeypatch.setattr(M, "doc_table", lambda s, d: frame)
    monkeypatch.setattr(M, "_topics", lambda s, d: (None, None, topics))
    assert M.t12_multimodal_compare(spark, "x").count() == 2
    assert seen.value == 100


@pytest.fixture
def parts(spark, monkeypatch, counted):
    """Training and test rows of three classes whose features are counted as they are computed, apart for both."""
    seen, of = counted
    frame = spark.createDataFrame([(float(i % 3), [float(i % 3 + i % 7), float(i % 11)], i % 5 == 0) for i in range(150)], "label double, f array<double>, is_test boolean")
    frame = frame.repartition(2)

    def rows(test, count):
        return frame.filter(F.col("is_test") == test).select("label", M.array_to_vector(of("array<double>")("f") if count else F.col("f")).alias("features"))

    def use(count_train, count_test):
        monkeypatch.setattr(M, "_parts", lambda s, d: (rows(False, count_train), rows(True, count_test)))

    return seen, use


def test_auc_scores_its_rows_once(spark, parts):
    seen, use = parts
    use(False, True)
    assert {r["cls"]: (r["n_pos"], r["n_neg"]) for r in M.ml_ovr_gbt_auc(spark, "x").collect()} == {0: (10, 20), 1: (10, 20), 2: (10, 20), -1: (30, 60)}
    assert seen.value == 30


def test_report_scores_its_rows_once(spark, parts):
    seen, use = parts
    use(False, True)
    assert M.ml_ovr_gbt_report(spark, "x").filter("cls = 'accuracy'").count() == 2
    assert seen.value == 30
