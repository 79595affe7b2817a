"""Forests that are fitted some trees at a time."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerline.operators import ml


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] > 0).astype(float) + (x[:, 1] > 1)
    made = [(i, float(c), *map(float, v)) for i, (c, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(made, "id long, label double, a double, b double, c double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).select("id", "label", "features").coalesce(1)


def _fits(monkeypatch):
    """(trees, seed, model) of every fit from here on."""
    seen, was = [], ml.random_forest

    def watched(trees, *args, **more):
        forest = was(trees, *args, **more)
        fit = forest.fit
        forest.fit = lambda df: seen.append((trees, more["seed"], fit(df))) or seen[-1][2]
        return forest

    monkeypatch.setattr(ml, "random_forest", watched)
    return seen


def test_parts_hold_few_nodes_and_add_up(rows, monkeypatch):
    """One fit of all trees held all their nodes on the driver."""
    seen = _fits(monkeypatch)
    got = {r["id"]: r for r in ml.forest_scores(rows, rows, 12, 4, nodes=100).collect()}
    assert sum(n for n, *_ in seen) == 12 and len(seen) > 2 and len({s for _, s, _ in seen}) == len(seen)
    assert all(m.totalNumNodes <= 100 for *_, m in seen)
    want: dict = {}
    for *_, model in seen:
        for r in model.transform(rows).collect():
            want[r["id"]] = want.get(r["id"], 0) + r["rawPrediction"].toArray()
    assert len(got) == 200
    for key, votes in want.items():
        assert got[key]["scores"] == pytest.approx(votes / 12) and sum(got[key]["scores"]) == pytest.approx(1)
        assert votes[int(got[key]["prediction"])] == pytest.approx(votes.max())
    assert np.mean([r["label"] == r["prediction"] for r in got.values()]) > 0.9


@pytest.mark.parametrize("nodes, fits", [(None, [5]), (150, [4, 5])])
def test_a_small_forest_is_one_fit_as_before(rows, monkeypatch, nodes, fits):
    """Also if only its first trees show that it is small."""
    seen = _fits(monkeypatch)
    got = ml.forest_scores(rows, rows, 5, 4, nodes=nodes).orderBy("id").select("prediction", F.col("scores")[0].alias("s")).collect()
    assert [n for n, *_ in seen] == fits
    want = ml.RandomForestClassifier(numTrees=5, maxDepth=4, minInstancesPerNode=2, featureSubsetStrategy="log2", seed=42).fit(rows)
    want = want.transform(rows).orderBy("id").collect()
    assert [(r["prediction"], r["s"]) for r in got] == [(r["prediction"], r["probability"][0]) for r in want]
