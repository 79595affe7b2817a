"""Items per (order, product) joined back to the items."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

from ledgerline.operators.orders import item_aggregate

ROWS = [
    (1, 1, 10, 7, "1.50"), (1, 2, 10, 7, "2.50"), (1, 3, 11, 8, None), (2, 1, 10, 9, "4.00"), (2, None, 10, 6, "1.00"),
    (3, 1, None, 5, "1.00"), (3, 2, None, 4, "2.00"), (None, 1, 10, 5, "1.00"), (None, 2, 10, 4, "2.00"), (None, 1, None, 3, "3.00"),
]
SCHEMA = "order_id long, order_item_id int, product_id long, seller_id long, price decimal(18,2)"


def _items(spark):
    return spark.createDataFrame([(*r[:4], None if r[4] is None else Decimal(r[4])) for r in ROWS], SCHEMA)


def _expected(rows):
    out = Counter()
    for key in {(r[0], r[2]) for r in rows}:
        own = [r for r in rows if (r[0], r[2]) == key]
        prices = [Decimal(r[4]) for r in own if r[4] is not None]
        sellers = [None] if None in key else [r[3] for r in own]
        for s in sellers:
            out[(*key, sum(r[1] is not None for r in own), sum(prices) if prices else None, s)] += 1
    return out


def _got(df):
    return Counter((r["order_id"], r["product_id"], r["number_of_items"], r["price"], r["seller_id"]) for r in df.collect())


def test_rows_without_order_or_product_come_once(spark):
    assert _got(item_aggregate(_items(spark))) == _expected(ROWS)


def test_one_exchange_serves_aggregate_and_join(spark):
    known = _items(spark).filter("order_id is not null")
    df = item_aggregate(known, orders_known=True)
    assert _got(df) == _expected([r for r in ROWS if r[0] is not None])
    plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
