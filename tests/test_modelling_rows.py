"""The modelling rows: what is dropped, and that the plan stays small."""

from __future__ import annotations

import math

import pytest

from ledgerline.plans import modelling as M

WIDE = [f"c{i}" for i in range(11)]


@pytest.fixture
def model(spark, monkeypatch):
    """A written-table stand-in with eleven features."""
    ones = [1] * 9
    rows = [
        ("a", 0, 1.5, 2, *ones), ("a", 0, 1.5, 2, *ones), (None, 0, 1.5, 2, *ones), ("b", None, 1.5, 2, *ones),
        ("c", 1, None, 2, *ones), ("d", 1, math.nan, 2, *ones), ("e", 1, 1.5, None, *ones), ("f", 2, math.inf, 3, *ones),
    ]
    schema = "review_id string, review_category int, c0 double, c1 int, " + ", ".join(f"{c} int" for c in WIDE[2:])
    monkeypatch.setattr(M, "FEATURES", WIDE)
    monkeypatch.setattr(M, "_model", lambda s, d: s.createDataFrame(rows, schema))


def test_rows_with_a_null_or_nan_are_dropped(spark, model):
    got = sorted((r["review_id"], r["label"], r["c0"], r["c1"]) for r in M.ml_rows(spark, "x").collect())
    assert got == [("a", 0.0, 1.5, 2.0), ("a", 0.0, 1.5, 2.0), ("f", 2.0, math.inf, 3.0)]
    assert len({r["row_id"] for r in M.ml_rows(spark, "x").collect()}) == 3


def test_conditions_do_not_multiply_with_the_columns(spark, model):
    """One condition over all columns gave the optimizer 2 ^ columns variants."""
    plan = M.ml_rows(spark, "x")._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1
    assert _most_conditions(plan) < 1000


def _most_conditions(plan) -> int:
    """Conditions that the optimizer holds for a step of the plan."""
    below = plan.children()
    return max([plan.validConstraints().size(), *[_most_conditions(below.apply(i)) for i in range(below.size())]])
