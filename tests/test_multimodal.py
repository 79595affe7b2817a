"""The comparison of document models."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import modelling as M


def test_features_and_models_do_not_wait_for_each_other(spark, monkeypatch):
    """The features were made after the topics, and the second model was fitted after the first."""
    inputs, fits = threading.Barrier(2), threading.Barrier(2)
    ids = [f"d{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, [0.5 + n % 2 / 4, 0.5 - n % 2 / 4]) for n, i in enumerate(ids)], "doc_id string, w array<double>")
    docs = docs.select("doc_id", M.array_to_vector("w").alias("topicDistribution"))
    rows = [(i, float(n % 2), n % 5 == 0, *[float(n * (j + 1) % 7) for j in range(len(M.DOC_FEATURES))]) for n, i in enumerate(ids)]
    split = spark.createDataFrame(rows, "doc_id string, label double, is_test boolean, " + ", ".join(f"{c} double" for c in M.DOC_FEATURES))
    monkeypatch.setattr(M, "_topics", lambda s, d: (inputs.wait(60), None, docs))
    monkeypatch.setattr(M, "_doc_split", lambda s, d: (inputs.wait(60), split)[1])
    monkeypatch.setattr(M, "LogisticRegression", lambda was=M.LogisticRegression, **k: (fits.wait(60), was(**k))[1])
    got = {r["model"]: r for r in M.t12_multimodal_compare(spark, "unused").collect()}
    assert got["numerics+topics"]["accuracy"] == pytest.approx(1.0) and {r["n_test"] for r in got.values()} == {12}
    assert split.filter(F.col("is_test")).count() == 12
