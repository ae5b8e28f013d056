"""Runs over a range of days against runs over all days, and what a failure leaves behind."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reachmill import contracts as names
from reachmill.plans import jobs
from reachmill.plans.jobs import Lake, silver_to_gold
from reachmill.sinks import staged
from reachmill.sinks.staged import Staging, Target, day_of, delta_condition
from reachmill.sinks.tables import silver_target, write_silver

FIRST = date(2026, 7, 1)
SCHEMAS = {
    names.SILVER_SALES: "fecha date, product_id string, product_name string, ventas_unidades bigint, ventas_importe double",
    names.SILVER_SPEND: "fecha date, ad_id string, product_id string, product_name string, price decimal(10,2), daily_spend decimal(10,2)",
    names.SILVER_SNAPSHOTS: "fecha date, ad_id string, ad_delivery_start_time date, country string, age_range string,"
                            " female bigint, male bigint, reach bigint",
}
GOLD = [names.GOLD_AD_DAILY, names.GOLD_AD_TOTAL, names.GOLD_REACH, names.GOLD_SATURATION]


def day(n):
    return FIRST + timedelta(days=n)


def silver_rows(seed):
    """Random silver rows of ten days: undated rows, rows without ad, late and missing starts."""
    pick = random.Random(seed)
    days = [day(n) for n in range(10)]
    sales = [(d, f"P{p}", f"n{p}", pick.randint(1, 9), pick.randint(1, 9999) / 100) for d in days for p in range(3) if pick.random() < 0.7]
    spend, snapshots = [], []
    for a in [*(f"a{k}" for k in range(12)), None]:
        products = [(None, None), *((f"P{p}", f"n{p}") for p in pick.sample(range(3), 2))]
        for d in [*days, None]:
            if pick.random() < 0.5:
                spend.append((d, a, *pick.choice(products), None, Decimal(pick.randint(0, 900)) / 100))
            if pick.random() < 0.5:
                start = pick.choice([d, day(pick.randint(-3, 9)), None])
                for age in pick.sample(["18", "25", "65"], pick.randint(1, 2)):
                    f, m = pick.randint(0, 50), pick.randint(0, 50)
                    snapshots.append((d, a, start, "ES", age, f, m, f + m))
    return {names.SILVER_SALES: sales, names.SILVER_SPEND: spend, names.SILVER_SNAPSHOTS: snapshots}


def store(spark, lake, tables):
    for name, data in tables.items():
        frame = spark.createDataFrame(data, SCHEMAS[name]).coalesce(1)
        write_silver(frame, lake.path(names.SILVER, name), rebalance=False)


def gold_rows(spark, lake):
    found = {}
    for name in GOLD:
        table = lake.read(spark, names.GOLD, name)
        columns = sorted(table.columns)
        found[name] = sorted((tuple(r) for r in table.select(*columns).collect()), key=str)
    state = lake.read(spark, jobs.STATE, jobs.AD_STATE).collect()
    found["state"] = sorted(((r["ad_id"], r["days"], r["products"]) for r in state), key=str)
    return found


def replaced(old, new, start, end):
    """The old rows with the days of a range from the new ones."""
    inside = lambda r: r[0] is not None and start <= r[0] <= end
    return {name: [r for r in old[name] if not inside(r)] + [r for r in new[name] if inside(r)] for name in old}


@pytest.mark.parametrize("seed, start, end", [(1, 3, 3), (2, 0, 1), (4, 2, 6)])
def test_a_changed_range_makes_gold_that_of_a_full_run(spark, tmp_path, seed, start, end):
    old, new = silver_rows(seed), silver_rows(seed + 100)
    lake, whole = Lake(str(tmp_path / "lake")), Lake(str(tmp_path / "whole"))
    store(spark, lake, old)
    silver_to_gold(spark, lake)
    after = replaced(old, new, day(start), day(end))
    store(spark, lake, after)
    silver_to_gold(spark, lake, start=day(start), end=day(end))
    store(spark, whole, after)
    silver_to_gold(spark, whole)
    assert gold_rows(spark, lake) == gold_rows(spark, whole)


def test_a_late_day_corrects_the_growth_after_it(spark, tmp_path):
    lake = Lake(str(tmp_path))
    snapshot = lambda n, reach: (day(n), "a", FIRST, "ES", "18", reach, 0, reach)
    tables = {names.SILVER_SALES: [], names.SILVER_SPEND: [], names.SILVER_SNAPSHOTS: [snapshot(0, 10), snapshot(4, 100)]}
    tables[names.SILVER_SALES] = [(FIRST, "P", "n", 1, 1.0)]
    tables[names.SILVER_SPEND] = [(FIRST, "a", None, None, None, Decimal("1.00"))]
    store(spark, lake, tables)
    silver_to_gold(spark, lake)
    tables[names.SILVER_SNAPSHOTS].append(snapshot(2, 40))
    store(spark, lake, tables)
    silver_to_gold(spark, lake, start=day(2), end=day(2))
    daily = lake.read(spark, names.GOLD, names.GOLD_AD_DAILY)
    assert {r["fecha"]: r["alcance"] for r in daily.collect()} == {day(0): 10, day(2): 30, day(4): 60}
    assert lake.read(spark, names.GOLD, names.GOLD_AD_TOTAL).first()["alcance_total"] == 100
    # and it goes again, with the day that had rows for it alone
    tables[names.SILVER_SNAPSHOTS].pop()
    store(spark, lake, tables)
    silver_to_gold(spark, lake, start=day(2), end=day(2))
    assert {r["fecha"]: r["alcance"] for r in daily.sparkSession.read.parquet(lake.path("gold", names.GOLD_AD_DAILY)).collect()} == {day(0): 10, day(4): 90}


def test_a_range_run_reads_no_history_of_snapshots(spark, tmp_path, monkeypatch):
    lake, seen = Lake(str(tmp_path)), []
    store(spark, lake, silver_rows(5))
    silver_to_gold(spark, lake)
    keep, add = Staging.keep, Staging.add

    def noted(method):
        def run(self, df, *rest):
            seen.extend(line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
            return method(self, df, *rest)

        return run

    monkeypatch.setattr(Staging, "keep", noted(keep))
    monkeypatch.setattr(Staging, "add", noted(add))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        silver_to_gold(spark, lake, start=day(9), end=day(9))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # one day of snapshots, of daily metrics and of reach
    for table_path in ("silver/meta_ads", f"gold/{names.GOLD_AD_DAILY}"):
        scans = [s for s in seen if table_path in s]
        assert scans and all("PartitionFilters: []" not in s and ("20260710" in s or "2026-07-10" in s) for s in scans)


# ---- staging --------------------------------------------------------------
def table(spark, *data):
    return spark.createDataFrame(data, "fecha date, n int")


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("fecha", "n").collect())


class Killed(Exception):
    pass


def test_a_run_killed_before_its_commit_changes_nothing(spark, tmp_path):
    path, folder = str(tmp_path / "t"), str(tmp_path / ".next")
    write_silver(table(spark, (day(0), 1)), path)
    staging = Staging(spark, folder)
    staging.add(table(spark, (day(0), 2)), Target(path, []))
    assert stored(spark, path) == [(day(0), 1)]
    again = Staging(spark, folder)
    assert stored(spark, path) == [(day(0), 1)] and not (tmp_path / ".next").exists()
    again.add(table(spark, (day(0), 3)), Target(path, []))
    again.commit()
    assert stored(spark, path) == [(day(0), 3)] and not (tmp_path / ".next").exists()


@pytest.mark.parametrize("moves", range(5))
def test_a_run_killed_after_its_commit_is_completed(spark, tmp_path, monkeypatch, moves):
    whole, daily, folder = str(tmp_path / "whole"), str(tmp_path / "daily"), str(tmp_path / ".next")
    write_silver(table(spark, (day(0), 1)), whole)
    write_silver(table(spark, (day(0), 1), (day(1), 1), (day(2), 1), (day(3), 1), (None, 7)), daily)
    staging = Staging(spark, folder)
    staging.add(table(spark, (day(0), 2)), Target(whole, []))
    rows = table(spark, (day(1), 2), (day(3), 2)).selectExpr("*", "year(fecha) anio", "month(fecha) mes", "day(fecha) dia")
    staging.add(rows, silver_target(daily, days=(day(1), day(3))))
    left, move = [moves], staged.Files.move

    def failing(self, source, target):
        if not target.endswith(staged.COMMITTED):
            if not left[0]:
                raise Killed
            left[0] -= 1
        move(self, source, target)

    monkeypatch.setattr(staged.Files, "move", failing)
    with pytest.raises(Killed):
        staging.commit()
    monkeypatch.undo()
    Staging(spark, folder)
    assert stored(spark, whole) == [(day(0), 2)]
    found = spark.read.parquet(daily).select("fecha", "n").collect()
    # the second day has no rows any more
    assert sorted(map(tuple, found), key=str) == sorted([(None, 7), (day(0), 1), (day(1), 2), (day(3), 2)], key=str)
    assert not (tmp_path / ".next").exists()


def test_days_of_folders_and_conditions():
    assert day_of("fecha=2026-07-02") == day(1) == day_of("anio=2026/mes=7/dia=2")
    assert day_of("fecha=__HIVE_DEFAULT_PARTITION__") is None and day_of("anio=2026/mes=7") is None
    target = Target("p", ["fecha"], "delta", True, "2026-07-01", None, ["2026-06-01"])
    assert delta_condition(target) == "(fecha >= date '2026-07-01') or fecha in (date '2026-06-01')"


def test_outside_keeps_undated_rows(spark):
    rows = table(spark, (day(0), 1), (day(1), 2), (None, 3))
    assert sorted(r["n"] for r in staged.outside(rows, day(1), day(1)).collect()) == [1, 3]
    assert rows.where(F.col("n") > 3).count() == 0
