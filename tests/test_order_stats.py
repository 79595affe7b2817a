"""Order statistics: ranges of even size whatever the values, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import order_stats as O
from ledgerline.operators.profile import box_stats, describe


def test_no_range_holds_more_than_twice_its_share(spark):
    values = [float(v) for v in np.random.default_rng(3).lognormal(size=20_000)] + [1e12, -1e15]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    per = O.value_counts_by(df.withColumn("g", F.lit("a")), F.col("x"), ["g"])
    sizes = [r["count"] for r in O.with_range(per, ["g"]).groupBy("_b").count().collect()]
    assert len(sizes) == O.RANGES and max(sizes) <= 2 * len(values) / O.RANGES


@pytest.mark.parametrize("ranges", [2, 8, 256])
def test_quantiles_equal_numpy(spark, monkeypatch, ranges):
    monkeypatch.setattr(O, "RANGES", ranges)
    rng = np.random.default_rng(4)
    groups = {"a": rng.integers(0, 9, 500).astype(float), None: rng.normal(size=77), "one": np.array([5.0]), "far": np.array([1.0, 2.0, 1e12])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: r for r in O.exact_quantiles(df, "x", ["g"], probs).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g].n == len(vs)
        assert [got[g][f"q{i}"] for i in range(len(probs))] == pytest.approx(np.quantile(vs, probs).tolist())


def test_describe_of_several_columns_and_empty(spark):
    df = spark.createDataFrame([(1, 2.0, None), (3, None, None), (8, 4.0, None)], "a int, b double, c double")
    got = {r.column_name: r for r in describe(df, ["a", "b", "c"]).collect()}
    assert (got["a"]["count"], got["a"].p50, got["b"].p25, got["c"]["count"], got["c"].p50) == (3, 3.0, 2.5, 0, None)
    empty = describe(df.limit(0), ["a", "b"]).collect()
    assert sorted((r.column_name, r["count"], r["mean"]) for r in empty) == [("a", 0, None), ("b", 0, None)]
    assert box_stats(df.limit(0), "a", ["b"]).collect() == []
