"""Plan-level properties: equivalences of the one-pass forms and scan pushdown."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF001


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_grouping_sets_equal_per_dimension_queries(spark):
    import __spark_entry__ as e

    q = e.queries()
    all_dims = q["dm_impact_all_dimensions"](spark, SF001)
    for key, dim in [("dm15_impact_by_region", "region"), ("dm16_impact_by_platform", "platform"),
                     ("dm17_impact_by_age_band", "age_band")]:
        single = {(r[dim], r.total_sales, r.prev_tot_sales, r.perc_diff_sales) for r in q[key](spark, SF001).collect()}
        from_sets = {(r.value, r.total_sales, r.prev_tot_sales, r.perc_diff_sales)
                     for r in all_dims.filter(F.col("dimension") == dim).collect()}
        assert single == from_sets, key


def test_year_filter_reaches_the_orders_scan(spark):
    import __spark_entry__ as e

    plan = _plan(e.queries()["dm15_impact_by_region"](spark, SF001))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_scans_read_only_needed_columns(spark):
    import __spark_entry__ as e

    plan = _plan(e.queries()["cb4_events_per_type"](spark, SF001))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all("value" not in s for s in schemas)  # events.value is never read
