import gzip
import json
import os
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reachmill import contracts as names
from reachmill.plans import bronze
from reachmill.plans.jobs import (
    Lake,
    backcast_to_landing,
    bronze_to_silver,
    landing_to_bronze,
    silver_to_gold,
    snapshot_to_landing,
)
from reachmill.runtime import SETTINGS, scratch_folder, tune
from reachmill.sinks.landing import write_envelopes
from reachmill.sinks.tables import append_absent, write_gold, write_silver
from reachmill.sources import kafka, landing, relational
from reachmill.streaming import capture
from reachmill.streaming import ingest as job
from reachmill.streaming.ingest import Ingested, ingest

D1, D2 = date(2026, 7, 1), date(2026, 7, 2)


def put(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    text = body if isinstance(body, str) else json.dumps(body, indent=2, ensure_ascii=False)
    (folder / name).write_text(text)


def event(i, product="P1", name="cap", quantity=1, amount=10.0):
    return {"event_id": i, "timestamp": "2026-07-01T10:00:00+00:00", "product_id": product,
            "product_name": name, "quantity": quantity, "unit_price": amount / quantity,
            "total_amount": amount, "region": "north", "channel": "ecommerce"}


def ad(i, female, male, start="2026-07-01"):
    ages = [{"age_range": "18-24", "female": female, "male": male, "unknown": 1}]
    return {"id": i, "eu_total_reach": female + male, "ad_delivery_start_time": start,
            "age_country_gender_reach_breakdown": [
                {"country": "ES", "age_gender_breakdowns": ages}]}


# ---- landing to bronze ----------------------------------------------------
def test_every_file_lands_whatever_its_name_or_age(spark, tmp_path):
    folder = tmp_path / "landing" / "ventas" / "2026" / "07" / "01"
    body = lambda i: {"batch_date": "2026-07-01", "events": [event(i)]}
    run = lambda: ingest(spark, str(tmp_path), "ventas", names.SALES_ENVELOPE, "events", bronze.sale_events)
    put(folder, "ventas_1.json", body("a"))
    put(folder, "sales_2.json", body("b"))
    put(folder, "p.json", body("c"))
    put(folder, "particulars", body("d"))
    with gzip.open(folder / "ventas_5.json.gz", "wt") as packed:
        packed.write(json.dumps(body("e"), indent=2))
    put(folder / "batch", "part-0.json", json.dumps(body("f")))
    run()
    put(folder, "restored.json", body("g"))
    os.utime(folder / "restored.json", (0, 0))
    run()
    stored = spark.read.parquet(str(tmp_path / "bronze" / "ventas"))
    assert sorted(r["event_id"] for r in stored.collect()) == list("abcdefg")


def test_a_batch_landed_again_is_ingested_once(spark, tmp_path):
    envelope = {"batch_date": "2026-07-01", "batch_timestamp": "t", "total_events": 1, "events": [event("a")]}
    batch = spark.read.schema(names.SALES_ENVELOPE).json(spark.sparkContext.parallelize([json.dumps(envelope)]))
    folder = str(tmp_path / "landing" / "ventas" / "2026" / "07" / "01" / "batch-0")
    for _ in range(2):
        write_envelopes(batch, folder)
        ingest(spark, str(tmp_path), "ventas", names.SALES_ENVELOPE, "events", bronze.sale_events)
    assert spark.read.parquet(str(tmp_path / "bronze" / "ventas")).count() == 1


def test_ingest_is_incremental(spark, tmp_path, rows):
    lake, landing = str(tmp_path), tmp_path / "landing" / "ventas"
    put(landing / "2026/07/01", "ventas_1.json",
        {"batch_date": "2026-07-01", "events": [event("a"), event("b")]})
    put(landing / "2026/07/01", "ventas_2.json", "{ broken")

    def run():
        return ingest(spark, lake, "ventas", names.SALES_ENVELOPE, "events", bronze.sale_events,
                      max_files=1)

    first = run()
    assert (first.rows, first.set_aside, first.files, first.batches) == (2, 1, 2, 2)
    assert run() == Ingested()
    put(landing / "2026/07/02", "ventas_3.json",
        {"batch_date": "2026-07-02", "events": [event("c")]})
    assert run().rows == 1
    table = spark.read.parquet(f"{lake}/bronze/ventas")
    assert rows(table, "fecha", "event_id", "anio", "mes", "dia") == [
        (D1, "a", 2026, 7, 1), (D1, "b", 2026, 7, 1), (D2, "c", 2026, 7, 2)
    ]
    assert (tmp_path / "bronze/ventas/anio=2026/mes=7/dia=2").is_dir()

    bad = spark.read.parquet(f"{lake}/quarantine/ventas_files").collect()
    assert len(bad) == 1 and bad[0]["file_path"].endswith("ventas_2.json")


class Killed(Exception):
    pass


def landed_events(spark, tmp_path):
    return sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "bronze/ventas")).collect())


@pytest.mark.parametrize("step", range(6))
def test_a_run_killed_anywhere_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, step):
    folder = tmp_path / "landing/ventas/2026/07/01"
    put(folder, "1.json", {"batch_date": "2026-07-01", "events": [event("a"), event("b")]})
    put(folder, "2.json", "{ broken")
    run = lambda: ingest(spark, str(tmp_path), "ventas", names.SALES_ENVELOPE, "events", bronze.sale_events)
    steps, reads = [0], []

    def counted(method):
        def call(*args, **kwargs):
            # killed before this step, or right after it
            if steps[0] == step // 2 and step % 2 == 0:
                raise Killed
            result = method(*args, **kwargs)
            if steps[0] == step // 2:
                raise Killed
            steps[0] += 1
            return result

        return call

    read = job.read_files
    monkeypatch.setattr(job, "read_files", lambda *a: reads.append(a[1]) or read(*a))
    noted = job.read_files
    monkeypatch.setattr(job, "_append", counted(job._append))
    monkeypatch.setattr(job.Ledger, "close", counted(job.Ledger.close))
    with pytest.raises(Killed):
        run()
    monkeypatch.undo()
    monkeypatch.setattr(job, "read_files", noted)
    # a file that comes meanwhile is not taken into the batch that is repeated
    put(folder, "3.json", {"batch_date": "2026-07-01", "events": [event("c")]})
    run()
    assert landed_events(spark, tmp_path) == ["a", "b", "c"]
    assert spark.read.parquet(str(tmp_path / "quarantine/ventas_files")).count() == 1
    assert [len(files) for files in reads[:1]] == [2] and sum(len(files) for files in reads) == 3
    assert run() == Ingested()


def test_archived_files_leave_landing_and_the_ledger(spark, tmp_path):
    folder = tmp_path / "landing/ventas/2026/07"
    run = lambda **k: ingest(spark, str(tmp_path), "ventas", names.SALES_ENVELOPE, "events", bronze.sale_events, **k)
    odd = ["a[1].json", "b{x,y}.json", "c*?.json", "d e.json", "part-0"]
    for n, name in enumerate(odd):
        put(folder / f"0{n % 2 + 1}", name, {"batch_date": "2026-07-01", "events": [event(name)]} if name != "part-0" else json.dumps({"batch_date": "2026-07-01", "events": [event(name)]}))
    assert run(max_files=2).files == 5
    assert run() == Ingested()
    assert run(archive=True) == Ingested()
    assert not [p for p in (tmp_path / "landing").rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert sorted(p.name for p in (tmp_path / "archive/ventas/2026/07").rglob("*") if p.is_file() and not p.name.startswith(".")) == sorted(odd)
    ledger = job.Ledger(spark, f"{tmp_path}/checkpoints/ventas_bronze", f"{tmp_path}/landing/ventas")
    assert ledger.listing().count() == 0 and not list((tmp_path / "checkpoints/ventas_bronze/files").glob("batch=*"))
    # the same path again is a new file; a file that was replaced is read again, and stays
    put(folder / "01", "a[1].json", {"batch_date": "2026-07-01", "events": [event("again")]})
    assert run(archive=True).rows == 1
    assert landed_events(spark, tmp_path) == sorted([*odd, "again"])


def test_undated_rows_land_in_the_default_partition(spark, tmp_path):
    put(tmp_path / "landing/meta_ads", "meta_ads_1.json", {"ads": [ad("x", 1, 1)]})
    ingest(spark, str(tmp_path), "meta_ads", names.SNAPSHOT_ENVELOPE, "ads", bronze.ad_snapshots)
    assert list((tmp_path / "bronze/meta_ads").glob("anio=__HIVE*"))
    table = spark.read.parquet(str(tmp_path / "bronze/meta_ads"))
    assert [r["fecha"] for r in table.collect()] == [None]


def test_newest_entry_is_found_by_descent(spark, tmp_path, monkeypatch):
    for n in range(60):
        put(tmp_path / f"202{n % 3}/{n % 12 + 1:02d}/{n % 28 + 1:02d}", f"meta_ads_{n}.json", "{}")
    (tmp_path / "2026/01/01/meta_ads_9").mkdir(parents=True)  # begun, without a part
    put(tmp_path / "2025/03/04/meta_ads_5", "part-0.json", "{}")
    put(tmp_path / "2025/03/04", "backcast_7.json", "{}")
    put(tmp_path / "2025/03/03", "meta_ads_8.json", "{}")
    listed = []
    children = landing.Files.children
    monkeypatch.setattr(landing.Files, "children", lambda self, path: listed.append(path) or children(self, path))
    found = landing.newest_snapshot(spark, str(tmp_path), "meta_ads")
    assert found == str(tmp_path / "2025/03/04/meta_ads_5")
    # four levels, and three below the year without an entry
    assert len(listed) == 4 + 3
    assert landing.newest_snapshot(spark, str(tmp_path / "2026"), "meta_ads") is None
    assert landing.newest_snapshot(spark, str(tmp_path / "none"), "meta_ads") is None


# ---- capture --------------------------------------------------------------
def messages(spark, folder):
    return spark.readStream.text(str(folder)).select(
        F.col("value").cast("binary"),
        F.lit("2026-07-01T09:00:00Z").cast("timestamp").alias("timestamp"),
    )


def write_lines(folder, name, *texts):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(t if isinstance(t, str) else json.dumps(t) for t in texts))


def test_capture_lands_events_once_and_sets_junk_aside(spark, tmp_path, rows):
    inbox, lake = tmp_path / "inbox", str(tmp_path / "lake")
    write_lines(inbox, "1", event("a"), {"batch_date": "x", "events": [event("b"), event("c")]},
                "junk", "{}", {"events": []})

    def run():
        stream = messages(spark, inbox)
        capture.start_capture(stream, lake, trigger={"availableNow": True}).awaitTermination()

    def landed():
        return spark.read.option("recursiveFileLookup", True).json(f"{lake}/landing/ventas")

    run()
    run()
    got = landed().select("total_events", "batch_date", "batch_timestamp", F.inline("events"))
    assert rows(got, "event_id", "total_events") == [("a", 1), ("b", 1), ("c", 1)]
    row = got.first()
    assert row["batch_timestamp"].startswith(row["batch_date"] + "T")
    assert row["batch_timestamp"].endswith("+00:00")
    assert row["enqueued_time"].startswith("2026-07-01T09:00")
    folder = row["batch_date"].replace("-", "/")
    (unit,) = [p.name for p in (tmp_path / "lake/landing/ventas" / folder).iterdir()]
    assert unit.startswith("stream-") and unit.endswith(f"-batch-{0:012d}")
    junk = spark.read.option("recursiveFileLookup", True).json(f"{lake}/quarantine/ventas")
    assert sorted(r["raw"] for r in junk.collect()) == sorted(['{"events": []}', "junk", "{}"])

    write_lines(inbox, "2", event("d"))
    run()
    assert rows(landed().select(F.inline("events")), "event_id") == [
        ("a",), ("b",), ("c",), ("d",)
    ]
    ingest(spark, lake, "ventas", names.SALES_ENVELOPE, "events", bronze.sale_events)
    assert spark.read.parquet(f"{lake}/bronze/ventas").count() == 4


def test_batch_that_runs_again_replaces_its_files(spark, tmp_path, rows):
    write = capture.batch_writer(str(tmp_path))
    stamp = F.lit("2026-07-01T23:59:59Z").cast("timestamp")
    texts = spark.createDataFrame([(json.dumps(event("a")),)], "value string").select(
        F.col("value").cast("binary"), stamp.alias("timestamp")
    )
    batch = capture.parse_messages(texts).withColumn("batch_time", stamp)
    write(batch, 7)
    write(batch, 7)
    write(batch.limit(0), 8)
    assert [p.name for p in (tmp_path / "landing/ventas/2026/07/01").iterdir()] == [
        f"stream-manual-batch-{7:012d}"
    ]
    landed = spark.read.json(str(tmp_path / "landing/ventas/2026/07/01/*"))
    assert rows(landed, "batch_date", "batch_timestamp") == [
        ("2026-07-01", "2026-07-01T23:59:59.000000+00:00")
    ]


def test_batch_date_is_utc_in_any_session(spark, tmp_path, rows):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamp = F.lit("2026-07-01T02:00:00Z").cast("timestamp")
        texts = spark.createDataFrame([(json.dumps(event("a")),)], "value string").select(
            F.col("value").cast("binary"), stamp.alias("timestamp")
        )
        batch = capture.parse_messages(texts).withColumn("batch_time", stamp)
        capture.batch_writer(str(tmp_path))(batch, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    landed = spark.read.json(str(tmp_path / "landing/ventas/2026/07/01/*"))
    assert rows(landed, "batch_date", "batch_timestamp") == [
        ("2026-07-01", "2026-07-01T02:00:00.000000+00:00")
    ]


# ---- sources --------------------------------------------------------------
def test_kafka_options():
    options = kafka.kafka_options("secret", "ns.example", "sales", max_offsets_per_trigger=10)
    assert options["kafka.bootstrap.servers"] == "ns.example:9093"
    assert options["subscribe"] == "sales"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "10"
    jaas = options["kafka.sasl.jaas.config"]
    assert jaas.startswith(kafka.LOGIN_MODULE) and 'password="secret";' in jaas
    shaded = kafka.kafka_options("s", "ns", "t", login_module=kafka.SHADED_LOGIN_MODULE)
    assert shaded["kafka.sasl.jaas.config"].startswith("kafkashaded.")
    assert kafka.kafka_options("s", "ns", "t", configured_topic="other")["subscribe"] == "other"
    with pytest.raises(ValueError):
        kafka.kafka_options("s", "ns", None)


def test_jdbc_options(monkeypatch):
    database = relational.Database("jdbc:x://host", {"user": "u", "password": "p"})
    assert database.options("products") == {
        "url": "jdbc:x://host", "dbtable": "products", "fetchsize": "10000",
        "user": "u", "password": "p",
    }
    reads = []

    class Bounds:
        def __init__(self, low, high):
            self.row = {"lo": low, "hi": high}

        def first(self):
            return self.row

    def read(spark, database, table, split=None):
        reads.append((table, split))
        return Bounds(*bounds)

    monkeypatch.setattr(relational, "read_table", read)
    bounds = (3, 900)
    relational.campaign_tables(None, database, spend_partitions=8)
    assert [t for t, _ in reads[1:]] == ["daily_spend", "ad_product_mapping", "products"]
    assert reads[1][1].options() == {
        "partitionColumn": "id", "lowerBound": "3", "upperBound": "900", "numPartitions": "8",
    }
    bounds = (None, None)
    assert relational.spend_split(None, database, 8) is None


# ---- sinks ----------------------------------------------------------------
def test_silver_overwrite_whole_or_by_day(spark, tmp_path, rows):
    path = str(tmp_path / "t")

    def frame(*data):
        return spark.createDataFrame(data, "fecha date, n int")

    assert write_silver(frame((D1, 1), (D2, 2)), path) == 2
    assert write_silver(frame((D2, 5), (D2, 6)), path, only_days_present=True) == 2
    assert rows(spark.read.parquet(path), "fecha", "n") == [(D1, 1), (D2, 5), (D2, 6)]
    assert write_silver(frame((D2, 9)), path, rebalance=False) == 1
    assert rows(spark.read.parquet(path), "fecha", "n") == [(D2, 9)]


def test_gold_overwrite_replaces_schema_and_registers(spark, tmp_path, rows):
    path = str(tmp_path / "gold_t")
    assert write_gold(spark.range(3), path) == 3
    renamed = spark.range(2).select(F.col("id").alias("other"))
    assert write_gold(renamed, path, "marketing.gold_t") == 2
    assert rows(spark.table("marketing.gold_t")) == [(0,), (1,)]
    assert spark.read.parquet(path).columns == ["other"]
    assert write_gold(spark.range(5), path, "marketing.gold_t") == 5
    assert spark.table("marketing.gold_t").columns == ["id"]
    spark.sql("drop table marketing.gold_t")


def test_append_absent(spark, tmp_path, rows):
    path = str(tmp_path / "products")
    spark.createDataFrame([("P1", 1)], "product_id string, price int").write.parquet(path)
    incoming = spark.createDataFrame([("P1", 7), ("P2", 8)], "product_id string, price int")
    for added in (1, 0):
        target = spark.read.parquet(path)
        assert append_absent(target, incoming, ["product_id"], path, ["price"]) == added
    assert rows(spark.read.parquet(path)) == [("P1", 1), ("P2", 8)]


def test_runtime(spark, tmp_path):
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


# ---- landing to gold ------------------------------------------------------
@pytest.fixture
def relational_tables(spark):
    spend = spark.createDataFrame(
        [(1, "a1", D1, Decimal("5.00")), (2, "a1", D2, Decimal("4.00")), (3, "a2", D2, Decimal("2.50"))],
        "id int, ad_id string, date date, daily_spend decimal(10,2)",
    )
    mapping = spark.createDataFrame([("a1", "P1"), ("a2", "P1")], "ad_id string, product_id string")
    products = spark.createDataFrame(
        [("P1", "cap", "hats", Decimal("10.00"))],
        "product_id string, product_name string, category string, price decimal(10,2)",
    )
    return spend, mapping, products


def test_landing_to_gold(spark, tmp_path, rows, relational_tables):
    landing = tmp_path / "landing"
    put(landing / "meta_ads/2026/07/01", "meta_ads_1.json",
        {"extraction_date": "2026-07-01", "total_ads": 1, "ads": [ad("a1", 6, 4)]})
    put(landing / "meta_ads/2026/07/02", "meta_ads_2.json",
        {"total_ads": 2, "ads": [ad("a1", 9, 4), ad("a2", 2, 0, "2026-07-02")]})
    put(landing / "ventas/2026/07/01", "ventas_1.json",
        {"batch_date": "2026-07-01", "events": [event("e1", quantity=2, amount=20.0), event("e2")]})
    put(landing / "ventas/2026/07/02", "ventas_2.json",
        {"batch_date": "2026-07-02", "events": [event("e3", amount=9.5)]})

    lake = Lake(str(tmp_path))
    for _ in range(2):
        assert set(landing_to_bronze(spark, lake)) == {"ventas", "meta_ads"}
    written = bronze_to_silver(spark, lake, *relational_tables)
    assert written == {"ventas_diarias": 2, "ad_spend": 3, "meta_ads": 3}
    assert written.read == {"daily_spend": 3, "ad_product_mapping": 2, "products": 1}
    assert silver_to_gold(spark, lake, schema="campaigns") == {
        "gold_demographic_reach": 5, "gold_ad_daily_metrics": 3,
        "gold_ad_total_metrics": 2, "gold_saturation_curve": 2,
    }
    columns = ["fecha", "ad_id", "product_id", "product_name", "gasto", "alcance",
               "ventas_unidades", "ventas_importe", "roas", "dias_desde_inicio"]
    assert rows(spark.table("campaigns.gold_ad_daily_metrics"), *columns) == [
        (D1, "a1", "P1", "cap", Decimal("5.00"), 10, 3, 30.0, 6.0, 0),
        (D2, "a1", "P1", "cap", Decimal("4.00"), 3, 1, 9.5, 2.38, 1),
        (D2, "a2", "P1", "cap", Decimal("2.50"), 2, 1, 9.5, 3.8, 0),
    ]
    assert rows(spark.table("campaigns.gold_ad_total_metrics")) == [
        ("a1", "P1", "cap", Decimal("9.00"), 13, 4, 39.5, 4.39),
        ("a2", "P1", "cap", Decimal("2.50"), 2, 1, 9.5, 3.8),
    ]
    assert rows(spark.read.parquet(lake.path("gold", "gold_saturation_curve"))) == [
        (D1, Decimal("5.00"), 3, 30.0, 6.0), (D2, Decimal("6.50"), 1, 9.5, 1.46),
    ]
    nothing = bronze_to_silver(spark, lake, relational_tables[0].limit(0), *relational_tables[1:], start=D2, end=D2)
    assert nothing["ad_spend"] == 0 and nothing.read["daily_spend"] in (0, None)
    # a rerun over the same files and tables changes nothing
    bronze_to_silver(spark, lake, *relational_tables)
    assert silver_to_gold(spark, lake, schema="campaigns")["gold_ad_daily_metrics"] == 3


def test_pages_to_landing_to_backcast(spark, tmp_path, rows, relational_tables):
    lake, pages = Lake(str(tmp_path / "lake")), tmp_path / "pages"
    with pytest.raises(FileNotFoundError):
        (tmp_path / "lake/landing/meta_ads").mkdir(parents=True)
        backcast_to_landing(spark, lake, relational_tables[0], D2, days=2)
    put(pages, "1.json", {"data": [ad("a1", 8, 4)], "paging": {"cursors": {"after": "x"}}})
    put(pages, "2.json", {"data": [ad("a2", 6, 1, "2026-07-02T10:00:00Z")], "paging": {}})
    moment = datetime(2026, 7, 2, 1, 30, tzinfo=timezone(timedelta(hours=2)))
    landed = snapshot_to_landing(spark, lake, str(pages), moment)
    assert landed.endswith("/landing/meta_ads/2026/07/01/meta_ads_20260701_233000")

    for _ in range(2):  # the back-cast is not taken for a snapshot, so a rerun repeats it
        path = backcast_to_landing(spark, lake, relational_tables[0], D2, days=2)
    assert path.endswith("/landing/meta_ads/2026/07/02/backcast_20260702")

    (tmp_path / "lake/landing/ventas").mkdir()
    landing_to_bronze(spark, lake)
    table = spark.read.parquet(lake.path("bronze", "meta_ads"))
    # one real snapshot, and 5.00 of 11.50 spent by the first day of the period
    assert rows(table, "fecha", "ad_id", "eu_total_reach") == [
        (D1, "a1", 12), (D1, "a1", 5), (D1, "a2", 7), (D2, "a1", 12), (D2, "a2", 7)
    ]
