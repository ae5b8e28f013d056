"""Documents that several tasks read, against the reader of whole documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from reachmill.contracts import SALES_ENVELOPE
from reachmill.sources.landing import read_envelopes, read_files

TRICKY = ['a}b', '{"', '\\\\', '\\"}', "}{][", "é\u2028}", "", "\n\t}", '\\', '"', "x" * 300]


@pytest.fixture
def many_splits(spark):
    """Byte ranges of some hundred bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "1501", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    yield
    for name in conf:
        spark.conf.unset(name)


def envelope(pick, n):
    events = [{"event_id": pick.choice(TRICKY), "product_name": pick.choice(TRICKY), "quantity": pick.randint(1, 3)} for _ in range(pick.randint(0, 4))]
    return {"batch_date": "2026-07-01", "batch_timestamp": pick.choice(TRICKY), "total_events": n, "events": events}


def documents(seed):
    pick = random.Random(seed)
    some = [envelope(pick, n) for n in range(25)]
    dumped = [json.dumps(e, ensure_ascii=pick.random() < 0.5) for e in some]
    return {
        "list.json": json.dumps(some, indent=2),
        "compact.json": "[" + ",".join(dumped) + "]",
        "concatenated.json": "".join(dumped),
        "lines.txt": "\ufeff" + "\n".join(dumped) + "\n",
        "lists": "\n".join("[" + ", ".join(dumped[k : k + 5]) + " ]" for k in range(0, 25, 5)),
        "one.json": json.dumps(some[0], indent=1),
    }


def shown(df):
    return sorted(str(tuple(r)) for r in df.withColumn("file_path", F.regexp_extract("file_path", "[^/]*$", 0)).collect())


@pytest.mark.parametrize("seed", range(2))
def test_records_are_those_of_whole_documents(spark, tmp_path, many_splits, seed):
    folder = tmp_path / "docs"
    folder.mkdir()
    for name, text in documents(seed).items():
        (folder / name).write_text(text, encoding="utf-8")
    files = [(str(p), p.stat().st_size) for p in folder.iterdir()]
    found = read_files(spark, files, SALES_ENVELOPE, str(tmp_path / "scratch"), large=0)
    whole = read_envelopes(spark, str(folder), "ventas", SALES_ENVELOPE)
    assert shown(found) == shown(whole) and found.where("_corrupt_record is not null").count() == 0
    # several tasks have read a document
    pieces = spark.read.parquet(str(tmp_path / "scratch"))
    assert pieces.groupBy("file_path").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] > 3


def test_what_is_no_record_is_set_aside(spark, tmp_path, many_splits):
    good = json.dumps({"batch_date": "d", "events": []})
    texts = {"cut": f'[{good}, {good}, {{"batch_date": "x', "junk": f"[{good}, 17, {good}]", "type": f'[{good}, {{"events": 5}}]', "none": "nothing here"}
    files = []
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
        files.append((str(tmp_path / name), len(text)))
    rows = read_files(spark, files, SALES_ENVELOPE, str(tmp_path / "scratch"), large=0)
    found = {}
    for r in rows.collect():
        found.setdefault(r["file_path"].rsplit("/", 1)[1], []).append(r["_corrupt_record"])
    assert {name: (bad.count(None), sorted(b for b in bad if b is not None)) for name, bad in found.items()} == {
        "cut": (2, ['{"batch_date": "x']),
        "junk": (1, [f"17, {good}"]),
        "type": (1, ['{"events": 5}']),
        "none": (0, ["nothing here"]),
    }
