import json
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from reachmill import contracts as names
from reachmill.plans import bronze, silver
from reachmill.sources.landing import newest_snapshot, parse_envelopes, read_envelopes

AGES = [{"age_range": "18-24", "female": 3, "male": None, "unknown": 9}]


def ad(identity, breakdown, start="2026-07-01"):
    return {
        "id": identity, "eu_total_reach": 10, "ad_delivery_start_time": start,
        "target_gender": "All", "target_ages": ["18"], "publisher_platforms": ["site"],
        "age_country_gender_reach_breakdown": breakdown, "impressions": "dropped",
    }


def snapshots(spark, *files):
    texts = spark.createDataFrame(
        [(p, json.dumps(b) if b is not None else "{broken") for p, b in files],
        "file_path string, value string",
    )
    return parse_envelopes(texts, names.SNAPSHOT_ENVELOPE)


def test_snapshot_day_comes_from_envelope_then_path(spark, rows):
    breakdown = [{"country": "ES", "age_gender_breakdowns": AGES}]
    envelopes = snapshots(
        spark,
        ("x/2026/07/09/a.json", {"extraction_date": "2026-07-10", "ads": [ad("1", breakdown)]}),
        ("x/2026/07/09/b.json", {"ads": [ad("2", breakdown)]}),
        ("x/c.json", {"ads": [ad("3", breakdown, start="bad")]}),
        ("x/2026/07/09/d.json", {"extraction_date": "", "ads": [ad("4", breakdown)]}),
        ("x/2026/07/09/e.json", None),
        ("x/2026/07/09/f.json", {"extraction_date": "2026-07-10", "ads": []}),
    )
    got = rows(bronze.ad_snapshots(envelopes), "ad_id", "fecha", "ad_delivery_start_time")
    start = date(2026, 7, 1)
    assert got == [
        ("1", date(2026, 7, 10), start),
        ("2", date(2026, 7, 9), start),
        ("3", None, None),
        ("4", date(2026, 7, 9), start),
    ]


def test_sale_day_is_the_batch_date(spark, rows):
    event = {"event_id": "s1", "timestamp": "2026-07-01T23:30:00+02:00", "quantity": 2,
             "unit_price": 4.5, "total_amount": 9.0, "extra": 1}
    text = json.dumps({"batch_date": "2026-07-03", "total_events": 2, "events": [event, event]})
    df = spark.createDataFrame(
        [("a", text), ("b", "junk"), ("c", '{"batch_date": "2026-07-03"}')],
        "file_path string, value string",
    )
    envelopes = parse_envelopes(df, names.SALES_ENVELOPE)
    got = bronze.sale_events(envelopes)
    assert rows(got, "fecha", "event_id", F.col("timestamp").cast("string")) == [
        (date(2026, 7, 3), "s1", "2026-07-01 21:30:00")
    ] * 2
    assert got.columns == ["fecha", *names.SALE_FIELDS]
    assert rows(bronze.unreadable(envelopes, "events"), "file_path") == [("b",), ("c",)]


def test_landing_reader_takes_documents_and_lines(spark, rows, tmp_path):
    folder = tmp_path / "landing" / "ventas"
    (folder / "2026" / "07" / "01").mkdir(parents=True)
    (folder / "2026" / "07" / "02" / "batch-1").mkdir(parents=True)
    body = {"batch_date": "2026-07-01", "events": [{"event_id": "a"}, {"event_id": "b"}]}
    (folder / "2026/07/01/ventas_1.json").write_text(json.dumps(body, indent=2))
    (folder / "2026/07/01/ventas_2.json").write_text("{ not json")
    lines = "\n".join(json.dumps(body) for _ in range(3))
    (folder / "2026/07/02/batch-1/part-0.json").write_text(lines)
    envelopes = read_envelopes(spark, str(folder), "ventas", names.SALES_ENVELOPE)
    assert bronze.sale_events(envelopes).count() == 8
    broken = bronze.unreadable(envelopes, "events").collect()
    assert len(broken) == 1 and broken[0]["file_path"].endswith("ventas_2.json")
    assert "not json" in broken[0]["_corrupt_record"]


def test_newest_snapshot_is_last_in_name_order(spark, tmp_path):
    def newest():
        return newest_snapshot(spark, str(tmp_path), "meta_ads")

    (tmp_path / "other.json").write_text("{}")
    assert newest() is None
    for name in ("meta_ads_20260701_1.json", "meta_ads_backfill_20260630.json"):
        (tmp_path / name).write_text("{}")
    assert newest().endswith("/meta_ads_backfill_20260630.json")
    (tmp_path / "meta_ads_z").mkdir()
    (tmp_path / "meta_ads_z" / "part-1.json").write_text("{}")
    assert newest().endswith("/meta_ads_z")


def test_daily_sales_sums_duplicates_and_drops_undated(spark, rows):
    d = date(2026, 7, 1)
    events = spark.createDataFrame(
        [(d, "e1", "P1", "one", 1, 10.005), (d, "e1", "P1", "one", 1, 10.0),
         (d, "e2", "P1", "renamed", 2, 5.0), (None, "e3", "P1", "one", 9, 9.0)],
        "fecha date, event_id string, product_id string, product_name string,"
        " quantity bigint, total_amount double",
    )
    assert rows(silver.daily_sales(events)) == [
        (d, "P1", "one", 2, 20.01), (d, "P1", "renamed", 2, 5.0)
    ]


def test_ad_spend_keeps_unmapped_ads_and_unknown_products(spark, rows):
    d = date(2026, 7, 1)
    spend = spark.createDataFrame(
        [(1, "a1", d, Decimal("5.00")), (2, "a2", d, Decimal("6.00")), (3, "a3", d, Decimal("7.00")),
         (4, None, d, Decimal("8.00"))],
        "id int, ad_id string, date date, daily_spend decimal(10,2)",
    )
    mapping = spark.createDataFrame([("a1", "P1"), ("a2", "P9")], "ad_id string, product_id string")
    products = spark.createDataFrame(
        [("P1", "one", "c", Decimal("3.00"))],
        "product_id string, product_name string, category string, price decimal(10,2)",
    )
    df = silver.ad_spend(spend, mapping, products)
    assert df.columns == ["fecha", "ad_id", "product_id", "product_name", "price", "daily_spend"]
    assert rows(df, "ad_id", "product_id", "product_name", "price", "daily_spend") == [
        (None, None, None, None, Decimal("8.00")),
        ("a1", "P1", "one", Decimal("3.00"), Decimal("5.00")),
        ("a2", "P9", None, None, Decimal("6.00")),
        ("a3", None, None, None, Decimal("7.00")),
    ]


def test_demographic_snapshots_drop_empty_breakdowns_and_unknown(spark, rows):
    envelopes = snapshots(
        spark,
        ("2026/07/09/a.json", {"ads": [
            ad("1", [{"country": "ES", "age_gender_breakdowns": AGES},
                     {"country": "FR", "age_gender_breakdowns": []},
                     {"country": "IT", "age_gender_breakdowns": None}]),
            ad("2", []),
            ad("3", None),
            ad("4", [{"country": "ES", "age_gender_breakdowns": [
                {"age_range": "65+", "unknown": 4}]}]),
        ]}),
    )
    got = silver.demographic_snapshots(bronze.ad_snapshots(envelopes))
    assert rows(got, "ad_id", "country", "age_range", "female", "male", "reach") == [
        ("1", "ES", "18-24", 3, 0, 3), ("4", "ES", "65+", 0, 0, 0)
    ]
