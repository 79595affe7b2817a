"""Forests whose trees are grown by tasks on their own."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from ledgerline.operators import forest, ml


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] > 0).astype(float) + (x[:, 1] > 1)
    made = [(f"r{i}", float(c), *map(float, v)) for i, (c, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(made, "id string, label double, a double, b double, c double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).select("id", "label", "features")


def _plain(bins, y, times, depth, least):
    """Class shares at each row's leaf, with all features at every node and without histograms."""
    out = np.zeros((2, bins.shape[1]))

    def gini(r):
        n = times[r].sum()
        return n - sum(times[r][y[r] == c].sum() ** 2 for c in (0, 1)) / n

    def split(r, held, d):
        best = (1e-6, None)
        for f in range(len(bins)) if d < depth else ():
            for b in range(forest.BINS - 1):
                left, right = r[bins[f][r] <= b], r[bins[f][r] > b]
                if min(times[left].sum(), times[right].sum()) >= least:
                    gain = gini(r) - gini(left) - gini(right)
                    best = (gain, (f, b)) if gain > best[0] + 1e-9 else best
        if best[1] is None:
            out[:, held] = np.array([[times[r][y[r] == c].sum()] for c in (0, 1)]) / times[r].sum()
            return
        f, b = best[1]
        for go in (lambda v: bins[f][v] <= b, lambda v: bins[f][v] > b):
            split(r[go(r)], held[go(held)], d + 1)

    split(np.flatnonzero(times), np.arange(bins.shape[1]), 0)
    return out


def test_a_tree_takes_the_best_splits(monkeypatch):
    monkeypatch.setattr(forest, "CHUNK", 3)
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 30, (3, 200)).astype(np.uint8)
    y = ((bins[0] > 12).astype(int) + (rng.random(200) < 0.2)) % 2
    times = forest.sampled(rng.integers(-(2**62), 2**62, 200), 9)
    assert 0.25 < (times == 0).mean() < 0.5 and 0.8 < times.mean() < 1.2
    tree = forest.grow(bins, y, times, 2, 5, 2, 3, np.random.default_rng(0))
    assert tree.depth == 5
    assert np.allclose(tree.votes(bins), _plain(bins, y, times, 5, 2))


def test_a_large_forest_is_not_fitted_part_after_part(rows, monkeypatch):
    """500 trees of depth 15 were fitted in some sixty parts, each of whose levels shuffled its nodes' histograms."""
    fits, was = [], ml.random_forest
    monkeypatch.setattr(ml, "random_forest", lambda trees, *a, **b: (fits.append(trees), was(trees, *a, **b))[1])
    got = [
        {r["id"]: r for r in ml.forest_scores(df, df, 40, 6, nodes=100, keys=["id"], one_task=400).collect()}
        for df in (rows.coalesce(1), rows.coalesce(1))
    ]
    assert fits == [1, 1]
    assert len(got[0]) == 400 and all(sum(r["scores"]) == pytest.approx(1) for r in got[0].values())
    assert np.mean([r["label"] == r["prediction"] for r in got[0].values()]) > 0.9
    assert all(r["scores"] == got[1][k]["scores"] for k, r in got[0].items())


def test_votes_do_not_depend_on_partitions(spark, rows):
    asked = rows.selectExpr("cast(substr(id, 2) as long) as n", "features")
    found = []
    for parts in (1, 5):
        v = forest.votes(rows.repartition(parts), ["id"], asked.repartition(parts), "n", range(7, 12), 3, 5, 2, 2, 3)
        found.append({r["n"]: r["votes"] for r in v.collect()})
    assert len(found[0]) == 400 and all(sum(v) == pytest.approx(5) for v in found[0].values())
    assert all(found[1][n] == pytest.approx(v) for n, v in found[0].items())
