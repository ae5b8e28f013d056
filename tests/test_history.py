from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from reachmill.contracts import AD, ADS_PAGE, KEYS, SNAPSHOT_ENVELOPE, SQL_PRODUCTS
from reachmill.operators import extraction, history, quality, upsert
from reachmill.plans import bronze, silver
from reachmill.plans.jobs import Lake, snapshot_to_landing
from reachmill.sinks.landing import backcast_envelopes, write_envelopes
from reachmill.sources.files import read_ads_pages, read_catalogue, read_raw_pages
from reachmill.sources.landing import read_envelopes

TODAY = date(2026, 7, 5)


def spend_frame(spark, *data):
    data = [(ad, date(2026, 7, d), Decimal(x)) for ad, d, x in data]
    return spark.createDataFrame(data, "ad_id string, date date, daily_spend decimal(10,2)")


def ad_frame(spark, *data):
    """(id, reach, start, female, male) per ad; breakdown None if female is None."""
    return spark.createDataFrame(
        [
            (i, reach, start, "All", ["18"], ["site"],
             None if f is None else [("ES", [("18-24", f, m, None)])])
            for i, reach, start, f, m in data
        ],
        AD,
    )


def test_last_days_and_spend_per_day(spark, rows):
    days = history.last_days(spark, TODAY, days=4)
    spend = spend_frame(spark, ("a", 3, "1.50"), ("b", 3, "2.00"), ("a", 5, "4.00"), ("a", 1, "9.00"))
    got = rows(history.spend_per_day(days, spend))
    assert got == [
        (date(2026, 7, 2), Decimal("0.00")), (date(2026, 7, 3), Decimal("3.50")),
        (date(2026, 7, 4), Decimal("0.00")), (date(2026, 7, 5), Decimal("4.00")),
    ]
    assert history.last_days(spark, TODAY).count() == 30


def test_cumulative_share(spark, rows):
    days = history.last_days(spark, TODAY, days=4)
    spend = spend_frame(spark, ("a", 3, "1.00"), ("a", 5, "3.00"))
    shares = history.cumulative_share(history.spend_per_day(days, spend))
    assert [r[2] for r in rows(shares)] == [0.0, 0.25, 0.25, 1.0]
    nothing = history.cumulative_share(history.spend_per_day(days, spend_frame(spark)))
    assert [r[2] for r in rows(nothing)] == [0.0] * 4


def test_backcast(spark, rows):
    ads = ad_frame(
        spark,
        ("old", 101, "2020-01-01", 50, 33), ("new", 10, "2026-07-04T22:00:00Z", 9, None),
        ("dateless", 5, "soon", 1, 1), ("bare", None, "2026-07-05", None, None),
        ("tomorrow", 5, "2026-07-06", 1, 1),
    )
    counter = Observation()
    days = history.last_days(spark, TODAY, days=3)
    spend = spend_frame(spark, ("a", 3, "1.00"), ("a", 4, "1.00"), ("a", 5, "2.00"))
    shares = history.cumulative_share(history.spend_per_day(days, spend))
    past = history.backcast_snapshots(history.with_start_date(ads, counter), shares)
    tree = F.col("age_country_gender_reach_breakdown")[0]["age_gender_breakdowns"][0]
    got = rows(past, F.dayofmonth("fecha"), "id", "eu_total_reach", tree["female"], tree["male"])
    assert got == [
        (3, "old", 25, 12, 8), (4, "new", 5, 4, None), (4, "old", 50, 25, 16),
        (5, "bare", 1, None, None), (5, "new", 10, 9, None), (5, "old", 101, 50, 33),
    ]
    assert counter.get == {"total": 5, "kept": 4}


def test_backcast_feeds_bronze(spark, rows, tmp_path):
    days = history.last_days(spark, TODAY, days=2)
    shares = history.cumulative_share(
        history.spend_per_day(days, spend_frame(spark, ("a", 4, "1.00"), ("a", 5, "1.00")))
    )
    ads = history.with_start_date(ad_frame(spark, ("x", 8, "2026-07-01", 4, 2)))
    envelopes = backcast_envelopes(history.backcast_snapshots(ads, shares))
    write_envelopes(envelopes, str(tmp_path / "meta_ads" / "backcast"))
    raw = spark.read.json(str(tmp_path / "meta_ads" / "backcast"))
    assert rows(raw, "extraction_timestamp", "is_synthetic", "total_ads") == [
        ("2026-07-04T00:00:00+00:00", True, 1), ("2026-07-05T00:00:00+00:00", True, 1)
    ]
    landed = read_envelopes(spark, str(tmp_path / "meta_ads"), "meta_ads", SNAPSHOT_ENVELOPE)
    flat = silver.demographic_snapshots(bronze.ad_snapshots(landed))
    assert rows(flat, "fecha", "ad_id", "eu_total_reach", "reach") == [
        (date(2026, 7, 4), "x", 4, 3), (date(2026, 7, 5), "x", 8, 6)
    ]


def test_product_weights(spark, rows):
    products = spark.createDataFrame([("P1",), ("P2",)], "product_id string")
    mapping = spark.createDataFrame(
        [("a", "P1"), ("b", "P1"), ("c", "P9")], "ad_id string, product_id string"
    )
    assert rows(history.product_weights(products, mapping)) == [("P1", 3), ("P2", 1)]


def test_absent_rows(spark, rows):
    schema = "product_id string, price int, n int"
    target = spark.createDataFrame([("P1", 1, 0)], schema)
    incoming = spark.createDataFrame(
        [("P1", 9, 1), ("P2", 5, 2), ("P2", 4, 3), ("P3", None, 4)], schema
    )
    new = upsert.absent_rows(target, incoming, KEYS[SQL_PRODUCTS], order_by=["n"])
    assert rows(new) == [("P2", 5, 2), ("P3", None, 4)]
    both = upsert.upserted(target, incoming, ["product_id"], ["n"])
    assert rows(both) == [("P1", 1, 0), ("P2", 5, 2), ("P3", None, 4)]
    again = upsert.upserted(both, incoming, ["product_id"], ["n"])
    assert rows(again) == rows(both)


def test_assemble_pages(spark, rows, tmp_path):
    (tmp_path / "p1.json").write_text(
        '{"data": [{"id": "1", "ad_delivery_start_time": "2026-07-01"},'
        ' {"id": "2", "eu_total_reach": 5}], "paging": {"cursors": {"after": "x"}}}'
    )
    (tmp_path / "p2.json").write_text('{"data": [{"id": "3"}], "paging": {}}')
    (tmp_path / "p3.json").write_text('{"data": [], "paging": {}}')
    (tmp_path / "p4.json").write_text("{}")
    moment = datetime(2026, 7, 5, 23, 30, 1, 500, tzinfo=timezone.utc)
    ads = extraction.assemble_pages(read_ads_pages(spark, str(tmp_path)), moment)
    stamp = ("2026-07-05", "2026-07-05T23:30:01.000500+00:00", 3)
    assert rows(ads, "extraction_date", "extraction_timestamp", "total_ads", "id") == [
        (*stamp, "1"), (*stamp, "2"), (*stamp, "3")
    ]
    nothing = extraction.assemble_pages(spark.createDataFrame([], ADS_PAGE), moment)
    assert nothing.count() == 0


def test_raw_pages(spark, rows, tmp_path):
    (tmp_path / "1.json").write_text('{"data": [{"id": "1", "other": {"x": 1.5}}, null]}\n{"data": []} {}')
    (tmp_path / "2.json").write_text('{"data": [{"id": "2"}, {"id"')
    (tmp_path / "3.json").write_text("")
    (tmp_path / "4.json").write_text('{"data": "none"}')
    pages = read_raw_pages(spark, str(tmp_path))
    torn = pages.where("_corrupt_record is not null")
    assert [r[0][-6:] for r in rows(torn, "file_path")] == ["2.json", "4.json"]
    moment = datetime(2026, 7, 5, tzinfo=timezone.utc)
    ads = extraction.raw_ads(pages.where("_corrupt_record is null"), moment)
    assert rows(ads, "total_ads", "ad") == [(1, '{"id":"1","other":{"x":1.5}}')]
    with pytest.raises(ValueError, match="2 unreadable pages.*2.json"):
        snapshot_to_landing(spark, Lake(str(tmp_path / "lake")), str(tmp_path), moment)
    assert not (tmp_path / "lake").exists()


def test_latest_snapshot_and_ids(spark, rows):
    data = [
        ("l/2026/07/05/meta_ads_20260705_1.json", [("1",), ("2",)]),
        ("l/2026/07/05/meta_ads_backfill_20260705.json", [("3",)]),
        ("l/2026/07/04/meta_ads_20260704_9.json", [("4",)]),
    ]
    envelopes = spark.createDataFrame(data, "file_path string, ads array<struct<id string>>")
    assert rows(extraction.ad_ids(extraction.latest_snapshot(envelopes))) == [("3",)]


def test_events_in_time_order(spark):
    events = [("b", "2026-07-01T10:00"), ("c", "2026-07-01T09:00"), ("a", "2026-07-01T10:00")]
    df = spark.createDataFrame(
        [(events,)], "events array<struct<event_id string, timestamp string>>"
    )
    ordered = df.select(extraction.in_time_order(F.col("events")).alias("e")).first()["e"]
    assert [e["event_id"] for e in ordered] == ["c", "a", "b"]


def test_catalogue(spark, rows, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"products": [\n {"id": "P1", "name": "cap", "category": "hats", "price": 9.9}]}'
    )
    got = read_catalogue(spark, str(tmp_path / "c.json"))
    assert rows(got) == [("P1", "cap", "hats", Decimal("9.90"))]


def test_key_checks(spark, rows):
    mapping = spark.createDataFrame(
        [("a", "P1"), ("a", "P2"), ("b", "P9"), (None, "P1"), ("c", None)],
        "ad_id string, product_id string",
    )
    products = spark.createDataFrame([("P1",), ("P2",)], "product_id string")
    assert rows(quality.duplicate_keys(mapping, ["ad_id"])) == [("a", 2)]
    assert rows(quality.orphans(mapping, products, "product_id"), "ad_id", "product_id") == [
        ("b", "P9"), ("c", None)
    ]
    assert rows(quality.null_counts(mapping, ["ad_id", "product_id"])) == [
        ("ad_id", 1), ("product_id", 1)
    ]


def test_event_rules(spark, rows):
    data = [
        ("ok", 3, 79.9, 239.7, "ecommerce"), ("price", 2, 10.0, 20.01, "ecommerce"),
        ("many", 4, 1.0, 4.0, "ecommerce"), ("shop", 1, 1.0, 1.0, "store"),
        ("no total", 1, 1.0, None, "ecommerce"),
    ]
    events = spark.createDataFrame(
        data, "event_id string, quantity bigint, unit_price double, total_amount double,"
              " channel string",
    )
    got = quality.event_violations(events, ["event_id", "total_amount"], [1, 2, 3], ["ecommerce"])
    assert rows(got) == [
        ("many", "quantity"), ("no total", "missing total_amount"),
        ("price", "total_amount"), ("shop", "channel"),
    ]


def test_event_rules_left_open_by_nulls_are_broken(spark, rows):
    schema = "event_id string, quantity bigint, unit_price double, total_amount double, channel string"
    events = spark.createDataFrame([("bare", None, 1.0, None, None), ("ok", 1, 1.0, 1.0, "ecommerce")], schema)
    got = quality.event_violations(events, ["event_id"], [1, 2, 3], ["ecommerce"])
    assert rows(got) == [("bare", "channel"), ("bare", "quantity"), ("bare", "total_amount")]


def test_envelope_counts(spark, rows):
    data = [("a", 2, [("x",), ("y",)]), ("b", 3, [("x",)]), ("c", None, [("x",)]), ("d", 1, None)]
    df = spark.createDataFrame(
        data, "file_path string, total_events bigint, events array<struct<id string>>"
    )
    wrong = quality.miscounted_envelopes(df, "total_events", "events")
    assert rows(wrong, "file_path", "actual") == [("b", 1), ("c", 1), ("d", 0)]
