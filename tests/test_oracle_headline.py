"""One headline query per family against its DuckDB oracle at sf0.01 (always on;
``LEDGERLINE_ORACLE=1`` runs every query in ``test_streaming_entry.test_oracle_all``)."""

import math

import pytest

from conftest import SF01

HEADLINE = [
    "dm15_impact_by_region",
    "dm_impact_all_dimensions",
    "cb10_visit_summary",
    "bk6_monthly_summary",
    "ec13_model_table",
    "ec23_score_box_by_volume",
    "in4_hotelling_gender",
    "t1_welch_by_segment",
    "ml_baseline_score_auc",
]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v if isinstance(v, (int, str)) else str(v)


@pytest.mark.parametrize("name", HEADLINE)
def test_headline_matches_oracle(spark, duck, name):
    import __spark_entry__ as e

    df = e.queries()[name](spark, SF01)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(e.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want
