"""Written tables: atomic replacement, one scan per query, rejected CSV lines, data-driven flags, stepwise selection."""

import contextlib
import io
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ledgerline.operators import encode, stepwise
from ledgerline.sources import read_csv_with_rejects, rejects_by_file, store


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_replace_keeps_columns_and_prunes(spark):
    df = spark.createDataFrame([(1, "a", 2000), (2, "b", 2001), (3, "c", None)], "id int, v string, year int")
    t = store.replace_table(spark, "t_replace", df, ["year"])
    assert t.columns == ["id", "v", "year"] and sorted(map(str, t.collect())) == sorted(map(str, df.collect()))
    one = t.filter("year = 2001").select("id")
    text = plan(one)
    assert "PartitionFilters: [isnotnull(year" in text and [r.id for r in one.collect()] == [2]
    for _ in range(3):
        t = store.replace_table(spark, "t_replace", df.filter("id > 1"), ["year"])
    assert t.count() == 2 and len(store.versions(spark, "t_replace")) == 2  # the current one and the one before


def test_failed_rewrite_leaves_the_old_table(spark):
    store.replace_table(spark, "t_failed", spark.range(5).toDF("id"))
    bad = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.replace_table(spark, "t_failed", bad)
    assert spark.table("t_failed").count() == 5
    with pytest.raises(Exception, match="no"):
        store.shared_table(spark, "t_never", "/nowhere", lambda: bad)
    assert not spark.catalog.tableExists(store.table_name("t_never", "/nowhere"))


def test_model_queries_scan_the_written_table_once(spark):
    import __spark_entry__ as e

    for name in ("ec14_review_categories", "ec21_neutral_vs_positive_leads", "ec18_lead_by_score"):
        q = e.queries()[name](spark, SF001)
        text = plan(q)
        assert sum(line.startswith("(") and "Scan parquet" in line for line in text.splitlines()) == 1, name
    assert "PartitionFilters" in text or "review_category" in plan(e.queries()["ec21_neutral_vs_positive_leads"](spark, SF001))


def test_no_line_is_lost_whatever_a_query_reads(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n,when\n1,10,2020-01-01\n2,x,2020-01-02\n3\n4,40,2020-01-04,more\n")
    (tmp_path / "b.csv").write_text("id,n,when\n5,50,2020-01-05\n6,60,notadate\n")
    df = read_csv_with_rejects(spark, str(tmp_path), "id int, n int, when date")
    got = {r.source_file: (r.n_lines, r.n_rejected, r.n_kept) for r in rejects_by_file(df).collect()}
    assert got == {"a.csv": (4, 3, 1), "b.csv": (2, 1, 1)}
    assert sorted(r["_rejected"] for r in df.filter("_rejected is not null").select("_rejected").collect()) == ["2,x,2020-01-02", "3", "4,40,2020-01-04,more", "6,60,notadate"]
    assert [r.id for r in df.filter("_rejected is null").select("id").orderBy("id").collect()] == [1, 5]


def test_flags_of_colliding_unseen_and_null_levels(spark):
    df = spark.createDataFrame([("Toys",), ("toys",), ("big toys",), (None,)], "c string")
    d = encode.category_dictionary(df, "c")
    assert d == {"is_toys": ["Toys", "toys"], "is_big toys": ["big toys"]}
    later = spark.createDataFrame([("TOYS",), ("toys",), (None,), ("new",)], "c string")
    assert [(r["is_toys"], r["is_big toys"]) for r in encode.one_hot(later, "c", d).collect()] == [(0, 0), (1, 0), (0, 0), (0, 0)]
    assert {r.flag: (r.n_ones, r.n_rows) for r in encode.flag_totals(encode.one_hot(df, "c", d), list(d)).collect()} == {"is_toys": (2, 4), "is_big toys": (1, 4)}
    with pytest.raises(ValueError):
        encode.category_dictionary(df, "c", most=2)
    with pytest.raises(ValueError):
        encode.one_hot(df.withColumn("is_toys", F.lit(1)), "c", d)


def full_fit_path(x, y):
    """Forward selection that fits every candidate in full; lowest AIC joins."""

    def aic(cols):
        z = np.column_stack([np.ones(len(y)), *(x[:, c] for c in cols)])
        b = np.zeros(z.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-z @ b))
            b = b + np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]), z.T @ (y - p))
        p = 1 / (1 + np.exp(-z @ b))
        return -2 * (y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + 2 * z.shape[1]

    chosen, best, path = [], aic([]), []
    while len(chosen) < x.shape[1]:
        trials = {c: aic([*chosen, c]) for c in range(x.shape[1]) if c not in chosen}
        c = min(trials, key=trials.get)
        if trials[c] >= best:
            break
        chosen.append(c)
        best = trials[c]
        path.append((c, best))
    return path


def test_stepwise_path_equals_full_fits(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 5))
    x[:, 4] = x[:, 0] + 0.3 * x[:, 4]
    y = (rng.random(400) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 2] + 0.4 * x[:, 3])))).astype(float)
    df = spark.createDataFrame([(float(b), *map(float, a)) for a, b in zip(x, y)] + [(None, *[1.0] * 5)], "y double, " + ", ".join(f"x{i} double" for i in range(5)))
    scans = []
    real = stepwise._scan
    monkeypatch.setattr(stepwise, "_scan", lambda data, beta: scans.append(1) or real(data, beta))
    path = stepwise.forward(df, "y", [f"x{i}" for i in range(5)])
    want = full_fit_path(x, y)
    assert [f for _, f, *_ in path[1:]] == [f"x{c}" for c, _ in want]
    assert [a for _, _, a, _ in path[1:]] == pytest.approx([a for _, a in want])
    assert len(scans) <= 12 * (len(path) + 1)  # refits only, none per candidate
    assert all(s is None or s > 0 and math.isfinite(s) for *_, s in path)
