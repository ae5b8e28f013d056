from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reachmill.functions import dates, ratios, reach, response


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    data = [tuple(v for _, v in values.values())] or [(1,)]
    return spark.createDataFrame(data, schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-07-01", date(2026, 7, 1)),
        ("2026-07-01T23:30:00+02:00", date(2026, 7, 1)),
        ("", None),
        ("bad", None),
        (None, None),
    ],
)
def test_lenient_date(spark, text, expected):
    assert one(spark, dates.lenient_date(F.col("t")), t=("string", text)) == expected


def test_lenient_timestamp_normalises_the_offset(spark):
    parsed = dates.lenient_timestamp(F.col("t")).cast("string")
    assert one(spark, parsed, t=("string", "2026-07-01T23:30:00+02:00")) == "2026-07-01 21:30:00"
    assert one(spark, parsed, t=("string", "not a time")) is None


@pytest.mark.parametrize(
    "path, expected",
    [
        ("abfss://x/landing/meta_ads/2026/07/15/a.json", date(2026, 7, 15)),
        ("landing/meta_ads/a.json", None),
        ("landing/2026/99/99/a.json", None),
    ],
)
def test_date_in_path(spark, path, expected):
    assert one(spark, dates.date_in_path(F.col("p")), p=("string", path)) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-07-01", date(2026, 7, 1)),
        ("2026-07-01T23:59:59Z", date(2026, 7, 1)),
        ("2026-07-01T23:59:59-0500", date(2026, 7, 1)),
        ("2026-07-01 and more", date(2026, 7, 1)),
        ("20260701", date(2026, 7, 1)),
        ("20260701T101010Z", date(2026, 7, 1)),
        ("2026", None),
        ("2026-13-01", None),
        ("soon", None),
        (None, None),
    ],
)
def test_publication_date(spark, text, expected):
    assert one(spark, dates.publication_date(F.col("t")), t=("string", text)) == expected


def test_date_parts_and_folders(spark):
    df = spark.createDataFrame([(date(2026, 7, 5),), (None,)], "fecha date")
    got = [tuple(r)[1:] for r in dates.with_date_parts(df).collect()]
    assert got == [(2026, 7, 5), (None, None, None)]
    assert dates.dated_folder("landing", "ventas", date(2026, 7, 5)) == "landing/ventas/2026/07/05"
    path = dates.dated_path("landing", "ventas", F.col("d"), F.lit("a.json"))
    assert one(spark, path, d=("date", date(2026, 7, 5))) == "landing/ventas/2026/07/05/a.json"


@pytest.mark.parametrize(
    "n, d, expected", [(10.0, 4.0, 2.5), (10.0, 3.0, 3.33), (1.0, 0.0, 0.0), (1.0, -2.0, 0.0),
                       (1.0, None, 0.0), (0.0, 5.0, 0.0)]
)
def test_safe_ratio(spark, n, d, expected):
    got = one(spark, ratios.safe_ratio(F.col("n"), F.col("d")), n=("double", n), d=("double", d))
    assert got == expected


@pytest.mark.parametrize(
    "n, d, expected",
    [("43.29", "5.20", 8.33), ("-43.29", "5.20", -8.33), ("1.00", "0.00", 0.0),
     ("1.00", None, 0.0), ("0.01", "2.00", 0.01), ("99999999999.99", "0.01", 9999999999999.0)],
)
def test_exact_cent_ratio_rounds_half_up(spark, n, d, expected):
    got = one(
        spark, ratios.exact_cent_ratio(F.col("n"), F.col("d")),
        n=("decimal(18,2)", Decimal(n)), d=("decimal(18,2)", d and Decimal(d)),
    )
    assert got == expected


@pytest.mark.parametrize("spend, per_day, per_hour",
                         [(0.0, 10, 1), (100.0, 10, 1), (5000.0, 94, 5), (1e6, 180, 11)])
def test_saturating_response(spark, spend, per_day, per_hour):
    assert one(spark, response.daily_sales(F.col("s")), s=("double", spend)) == per_day
    assert one(spark, response.hourly_sales(F.col("s")), s=("double", spend)) == per_hour


@pytest.mark.parametrize("value, total, count",
                         [(100, 33, 33), (2, 1, 0), (0, 1, 0), (None, 1, None), (-5, 1, 0)])
def test_scaled_counts(spark, value, total, count):
    factor = F.lit(1 / 3)
    assert one(spark, reach.scaled_total(F.col("x"), factor), x=("bigint", value)) == total
    assert one(spark, reach.scaled_count(F.col("x"), factor), x=("bigint", value)) == count


def test_scaled_breakdown_keeps_shape_and_missing_counts(spark):
    from reachmill.contracts import REACH_BREAKDOWN

    tree = [("ES", [("18-24", 10, None, 3)]), ("FR", None)]
    df = spark.createDataFrame([(tree,), (None,)], f"b {REACH_BREAKDOWN}")
    got = df.select(reach.scaled_breakdown(F.col("b"), F.lit(0.5)).alias("b")).collect()
    assert got[0]["b"][0]["age_gender_breakdowns"][0].asDict() == {
        "age_range": "18-24", "female": 5, "male": None, "unknown": 1,
    }
    assert got[0]["b"][1]["age_gender_breakdowns"] is None
    assert got[1]["b"] is None


def test_partition_predicate_prunes_folders(spark, tmp_path):
    from reachmill.sources.files import read_stored

    days = spark.createDataFrame([(datetime(2026, m, 1).date(),) for m in (5, 6, 7)], "fecha date")
    dates.with_date_parts(days).write.partitionBy("anio", "mes", "dia").parquet(str(tmp_path / "t"))
    df = read_stored(spark, str(tmp_path / "t"), start=date(2026, 6, 1), end=date(2026, 6, 30))
    assert [r["fecha"] for r in df.collect()] == [date(2026, 6, 1)]
    # files of other months are never opened, so what is in them does not matter
    for file in (tmp_path / "t").glob("anio=2026/mes=[57]/**/part-*"):
        file.write_bytes(b"not parquet")
    again = spark.read.schema(df.schema).parquet(str(tmp_path / "t"))
    assert again.where(dates.between_days(date(2026, 6, 1), date(2026, 6, 30))).count() == 1


def test_money_sums_do_not_depend_on_the_layout(spark):
    amounts = spark.range(200_000).selectExpr("id % 3 as k", "1e9 + id * 0.01 as amount")
    sums = []
    for parts in (1, 7, 64):
        dealt = amounts.repartition(parts)
        sums.append(sorted(map(tuple, dealt.groupBy("k").agg(ratios.money_sum(dealt, "amount").alias("s")).collect())))
    assert sums[0] == sums[1] == sums[2]
    assert amounts.agg(ratios.money_sum(amounts, "amount").alias("s")).schema["s"].dataType.typeName() == "double"


def test_cent_ratio_of_very_large_amounts(spark):
    frame = spark.range(1).selectExpr("4e17D as n", "2e17D as d")
    assert frame.select(ratios.exact_cent_ratio(F.col("n"), F.col("d"))).first()[0] == 2.0
