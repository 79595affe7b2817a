"""Web-event and trip operators on literal fixtures."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from ledgerline.operators.events import funnel, match_campaigns, visit_summary
from ledgerline.operators.share import value_counts
from ledgerline.operators.trips import clean_trips, modes
from ledgerline.plans.standins import event_names, page_hierarchy
from ledgerline.sources.tables import read_csv_set, write_csv

T = dt.datetime


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "event_id long, cookie_id string, visit_id string, page_id int, event_type int, event_time timestamp"
    )


def test_visit_summary_traps(spark):
    rows = [
        # visit v1: cart adds out of id order (time decides), two purchases, checkout twice
        (1, "c1", "v1", 1, 1, T(2024, 1, 10, 9, 0)),
        (2, "c1", "v1", 4, 2, T(2024, 1, 10, 9, 5)),
        (3, "c1", "v1", 3, 2, T(2024, 1, 10, 9, 3)),
        (4, "c1", "v1", 12, 1, T(2024, 1, 10, 9, 6)),
        (5, "c1", "v1", 13, 3, T(2024, 1, 10, 9, 7)),
        (6, "c1", "v1", 13, 3, T(2024, 1, 10, 9, 8)),
        (7, "c1", "v1", 1, 4, T(2024, 1, 10, 9, 9)),
        # visit v2: no cart adds, day after every campaign
        (8, "c2", "v2", 1, 1, T(2024, 1, 16, 9, 0)),
        # unknown cookie: dropped by the users join
        (9, "zz", "v3", 1, 1, T(2024, 1, 10, 9, 0)),
    ]
    users = spark.createDataFrame([(1, "c1"), (1, "c2")], "user_id long, cookie_id string")
    camps = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), dt.date(2024, 1, 10)), ("B", dt.date(2024, 1, 10), dt.date(2024, 1, 15))],
        "campaign_name string, start_date date, end_date date",
    )
    out = visit_summary(_events(spark, rows), users, event_names(spark), page_hierarchy(spark), camps).collect()
    v1 = sorted([r for r in out if r.visit_id == "v1"], key=lambda r: r.campaign_name)
    assert [r.campaign_name for r in v1] == ["A", "B"]  # end day of A and start day of B both match
    r = v1[0]
    assert r.cart_products == "Salmon, Kingfish"
    assert r.page_view_count == 2 and r.add_to_cart_count == 2 and r.purchase_flag == 1
    assert r.ad_impression_count == 1 and r.earliest_visit == dt.date(2024, 1, 10)
    v2 = [r for r in out if r.visit_id == "v2"]
    assert len(v2) == 1 and v2[0].campaign_name is None and v2[0].cart_products is None
    assert not [r for r in out if r.visit_id == "v3"]


def test_campaign_match_by_day_is_exact(spark):
    camps = spark.createDataFrame([("A", dt.date(2024, 1, 1), dt.date(2024, 1, 5)), ("B", None, dt.date(2024, 1, 5)),
                                   ("C", dt.date(2024, 1, 5), dt.date(2024, 1, 1))],
                                  "campaign_name string, start_date date, end_date date")
    visits = spark.createDataFrame([("v", dt.date(2024, 1, 5))], "visit_id string, d date")
    assert [r.campaign_name for r in match_campaigns(visits, camps, "d").collect()] == ["A"]
    late = spark.createDataFrame([("v", dt.datetime(2024, 1, 5, 15)), ("w", None)], "visit_id string, d timestamp")
    assert [r.campaign_name for r in match_campaigns(late, camps, "d").collect()] == [None, None]


def test_funnel_counts_and_dropoff(spark):
    df = spark.createDataFrame(
        [("v1", "view"), ("v1", "cart"), ("v1", "buy"), ("v2", "view"), ("v2", "cart"), ("v3", "view"), ("v4", "x")],
        "v string, e string",
    )
    out = {r.step: r for r in funnel(df, "v", {"view": F.col("e") == "view", "cart": F.col("e") == "cart",
                                                  "buy": F.col("e") == "buy"}).collect()}
    assert (out["view"].n_keys, out["cart"].n_keys, out["buy"].n_keys) == (3, 2, 1)
    assert out["view"].pct_of_keys == 75.0 and out["cart"].drop_off_pct == 33.33 and out["buy"].drop_off_pct == 50.0


def _trip_rows():
    return [
        ("2020-07-06 08:10:00", "2020-07-06 08:30:00", "member", "classic_bike", "S1", "E1"),
        ("2020-07-06 08:10:00", "2020-07-06 08:30:00", "member", "classic_bike", "S1", "E1"),  # exact duplicate
        ("2020-07-07 09:00:00", "2020-07-07 08:00:00", "member", "classic_bike", "S2", "E1"),  # negative
        ("2020-07-07 10:00:00", "2020-07-07 10:00:00", "member", "docked_bike", None, "E2"),  # zero, null station
        ("2020-07-07 10:30:00", "2020-07-07 10:45:00", "member", "docked_bike", "S2", "E2"),
        ("2021-07-05 10:30:00", "2021-07-05 10:45:00", "member", "docked_bike", "S3", "E2"),  # same month, other year
    ]


def test_clean_trips_and_modes(spark):
    raw = spark.createDataFrame(_trip_rows(), "started_at string, ended_at string, member_casual string, "
                                              "rideable_type string, start_station_name string, end_station_name string")
    t = clean_trips(raw)
    assert t.count() == 4  # duplicate and negative removed, zero kept
    m = {(r.year, r.month): r for r in modes(t, ["member_casual", "year", "month"],
                                             ["day_of_week", "start_station_name"]).collect()}
    r = m[(2020, 7)]
    # Monday (0) and Tuesday (1) each have ... Monday 1 ride, Tuesday 2 rides -> Tuesday
    assert r.top_day_of_week == "1" and r.n_day_of_week == 2
    # S1 once, S2 once, NULL never wins -> tie broken to the smallest value
    assert r.top_start_station_name == "S1" and r.n_start_station_name == 1
    assert m[(2021, 7)].top_start_station_name == "S3"


def test_multi_file_csv_read_and_value_counts(spark):
    d = tempfile.mkdtemp(prefix="ledgerline-test-csv-", dir="/tmp")
    raw = spark.createDataFrame(_trip_rows(), "started_at string, ended_at string, member_casual string, "
                                              "rideable_type string, start_station_name string, end_station_name string")
    write_csv(raw.filter(F.col("started_at") < "2021"), os.path.join(d, "202007"), single_file=True)
    write_csv(raw.filter(F.col("started_at") >= "2021"), os.path.join(d, "202107"), single_file=True)
    back = read_csv_set(spark, [os.path.join(d, "202007"), os.path.join(d, "202107")], raw.schema)
    assert back.count() == 6 and back.select("source_file").distinct().count() == 2
    vc = value_counts(clean_trips(back.drop("source_file")), ["member_casual", "rideable_type"]).collect()
    assert [(r.rideable_type, r["count"]) for r in vc] == [("docked_bike", 3), ("classic_bike", 1)]
