from datetime import date, timedelta
from decimal import Decimal

import brute
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reachmill.functions.ratios import exact_cent_ratio
from reachmill.operators import timeline
from reachmill.operators.skew import salted_left_join
from reachmill.plans import gold

DAY0 = date(2026, 7, 1)

SALES = ("fecha date, product_id string, product_name string, ventas_unidades bigint,"
         " ventas_importe decimal(18,2)")
SPEND = ("fecha date, ad_id string, product_id string, product_name string,"
         " price decimal(10,2), daily_spend decimal(10,2)")
SNAPSHOTS = ("fecha date, ad_id string, ad_delivery_start_time date, country string,"
             " age_range string, female bigint, male bigint, reach bigint")


def day(n):
    return None if n is None else DAY0 + timedelta(days=n)


def sale(d, pid, name, units, amount):
    return dict(fecha=day(d), product_id=pid, product_name=name, ventas_unidades=units,
                ventas_importe=Decimal(amount))


def cost(d, ad, pid, name, amount):
    return dict(fecha=day(d), ad_id=ad, product_id=pid, product_name=name, price=None,
                daily_spend=Decimal(amount))


def snap(d, ad, start, female, male, country="ES", age="18-24"):
    return dict(fecha=day(d), ad_id=ad, ad_delivery_start_time=day(start), country=country,
                age_range=age, female=female, male=male, reach=female + male)


class Lake:
    def __init__(self, spark, sales, spend, snapshots):
        def frame(data, schema):
            columns = [c.split()[0] for c in schema.split(", ")]
            return spark.createDataFrame([tuple(r[c] for c in columns) for r in data], schema)

        self.raw = (sales, spend, snapshots)
        self.sales = frame(sales, SALES)
        self.spend = frame(spend, SPEND)
        self.snapshots = frame(snapshots, SNAPSHOTS)

    def check_all(self):
        sales, spend, snapshots = self.raw
        daily = gold.ad_daily_metrics(
            self.sales, self.spend, self.snapshots, ratio=exact_cent_ratio
        )
        stored = [tuple(r) for r in daily.collect()]
        expected = brute.ad_daily(sales, spend, snapshots)
        assert {(r[1], r[0]): r[2:] for r in stored} == expected
        assert len(stored) == len(expected)

        totals = gold.ad_total_metrics(daily, ratio=exact_cent_ratio).collect()
        assert {tuple(r)[:3]: tuple(r)[3:] for r in totals} == brute.ad_totals(expected)

        curve = gold.saturation_curve(self.sales, self.spend, ratio=exact_cent_ratio).collect()
        assert {r[0]: tuple(r)[1:] for r in curve} == brute.saturation(sales, spend)

        reach = gold.demographic_reach(self.spend, self.snapshots).collect()
        assert sorted(map(tuple, reach), key=str) == brute.demographic_reach(spend, snapshots)


@pytest.fixture
def lake(spark):
    """Gaps, dips, late starts, strays and mismatches, all in one lake."""
    sales = [
        sale(0, "P1", "one", 2, "20.00"), sale(1, "P1", "one", 1, "10.00"),
        sale(1, "P1", "one", 1, "0.10"), sale(2, "P1", "other name", 9, "90.00"),
        sale(3, "P2", "two", 4, "43.29"), sale(9, "P1", "one", 7, "70.00"),
        sale(3, None, None, 5, "50.00"), sale(3, "P3", None, 5, "50.00"),
    ]
    spend = [
        cost(0, "gaps", "P1", "one", "8.00"), cost(2, "gaps", "P1", "one", "0.00"),
        cost(3, "twin", "P1", "one", "3.00"), cost(3, "two", "P2", "two", "5.20"),
        cost(8, "gaps", "P1", "one", "99.00"),          # no snapshot on that day
        cost(-5, "gaps", "P1", "one", "1.00"),          # before everything
        cost(3, "unmapped", None, None, "2.00"),
        cost(3, "unnamed", "P3", None, "2.00"),
        cost(1, "picky", "P2", "two", "1.00"), cost(2, "picky", "P1", "one", "1.00"),
        cost(3, "picky", None, None, "1.00"),
        cost(3, "never seen", "P1", "one", "6.00"),
        cost(3, None, "P1", "one", "7.00"), cost(None, "gaps", "P1", "one", "7.00"),
    ]
    snapshots = [
        snap(0, "gaps", 0, 5, 5), snap(3, "gaps", 0, 9, 3), snap(5, "gaps", 0, 10, 10),
        snap(1, "dips", 0, 10, 0), snap(2, "dips", 0, 4, 0), snap(4, "dips", 0, 12, 0),
        snap(2, "late start", 4, 3, 3), snap(3, "late start", 4, 5, 5),
        snap(5, "late start", 4, 9, 9),
        snap(5, "early start", -9, 1, 1),
        snap(3, "double", 3, 1, 1), snap(3, "double", 3, 2, 2, country="FR"),
        snap(3, "double", 2, 0, 0, age="65+"),
        snap(3, "no start", None, 8, 8),
        snap(None, "undated first", 0, 100, 0), snap(3, "undated first", 0, 130, 0),
        snap(None, "undated only", 3, 7, 0),
        snap(3, "future", 40, 6, 6),
        snap(1, "twin", 1, 1, 0), snap(1, "two", 1, 1, 0), snap(3, "picky", 0, 1, 0),
        snap(3, "unmapped", 1, 1, 1), snap(3, "unnamed", 1, 1, 1),
        snap(3, None, 1, 4, 4), snap(4, None, 1, 9, 4),
    ]
    return Lake(spark, sales, spend, snapshots)


def test_gold_tables_match_brute_force_on_edge_cases(lake):
    lake.check_all()


def test_gap_days_and_dips(lake, rows):
    daily = gold.ad_daily_metrics(lake.sales, lake.spend, lake.snapshots)
    reach = {(r["ad_id"], r["fecha"]): r["alcance"] for r in daily.collect()}
    assert [reach[("gaps", day(n))] for n in range(6)] == [10, 0, 0, 2, 0, 8]
    assert [reach[("dips", day(n))] for n in range(6)] == [0, 10, 0, 0, 8, 0]
    assert [reach.get(("late start", day(n))) for n in range(6)] == [None] * 4 + [0, 8]
    assert reach[("undated first", day(3))] == 30


def test_ad_days_equal_grid_with_joins(lake, rows):
    joined = (
        timeline.active_grid(lake.snapshots, lake.spend)
        .join(timeline.spend_by_ad_day(lake.spend), ["fecha", "ad_id"], "left")
        .join(timeline.reach_deltas(lake.snapshots, lake.spend), ["fecha", "ad_id"], "left")
    )
    direct = timeline.ad_days(lake.snapshots, lake.spend)
    columns = ["fecha", "ad_id", "product_id", "product_name", "fecha_inicio_anuncio"]
    assert rows(direct, *columns) == rows(joined, *columns)
    known = [F.coalesce(c, F.lit(0)) for c in ("gasto", "alcance")]
    assert rows(direct, *columns, *known) == rows(joined, *columns, *known)


def test_empty_inputs_give_empty_tables(spark):
    Lake(spark, [], [], []).check_all()
    Lake(spark, [], [], [snap(0, "a", 0, 1, 1)]).check_all()
    Lake(spark, [], [cost(0, "a", "P1", "one", "1.00")], []).check_all()


def test_types_follow_the_contract(spark):
    double_sales = Lake(spark, [], [], []).sales.withColumn(
        "ventas_importe", F.col("ventas_importe").cast("double")
    )
    empty = Lake(spark, [], [], [])
    daily = gold.ad_daily_metrics(double_sales, empty.spend, empty.snapshots)
    assert dict(daily.dtypes) == {
        "fecha": "date", "ad_id": "string", "product_id": "string", "product_name": "string",
        "gasto": "decimal(21,2)", "alcance": "bigint", "ventas_unidades": "bigint",
        "ventas_importe": "double", "roas": "double", "dias_desde_inicio": "int",
    }
    assert dict(gold.ad_total_metrics(daily).dtypes) == {
        "ad_id": "string", "product_id": "string", "product_name": "string",
        "gasto_total": "decimal(32,2)", "alcance_total": "bigint",
        "ventas_unidades_total": "bigint", "ventas_importe_total": "double",
        "roas_total": "double",
    }
    assert dict(gold.saturation_curve(double_sales, empty.spend).dtypes) == {
        "fecha": "date", "gasto_total_dia": "decimal(21,2)",
        "ventas_unidades_total_dia": "bigint", "ventas_total_dia": "double",
        "roas_global": "double",
    }
    assert dict(gold.demographic_reach(empty.spend, empty.snapshots).dtypes) == {
        "fecha": "date", "ad_id": "string", "product_id": "string", "product_name": "string",
        "country": "string", "age_range": "string", "gender": "string", "reach": "bigint",
    }


def test_salted_join_equals_plain_join(spark, rows):
    left = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7))
        .alias("key"),
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("value"),
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3), (None, 4)],
                                  "key string, other int")
    for buckets in (1, 4):
        salted = salted_left_join(left, right, ["key"], ["value"], buckets)
        assert rows(salted) == rows(left.join(right, ["key"], "left"))
        assert salted.columns == ["key", "value", "other"]


ADS, PRODUCTS, DAYS = ["a", "b", "c"], [("P1", "one"), ("P2", "two"), (None, None)], range(6)
money = st.integers(0, 5000).map(lambda c: str(Decimal(c) / 100))


@st.composite
def lakes(draw):
    product = {ad: draw(st.sampled_from(PRODUCTS)) for ad in ADS}
    sales = [
        sale(draw(st.sampled_from(DAYS)), *draw(st.sampled_from(PRODUCTS[:2])),
             draw(st.integers(0, 9)), draw(money))
        for _ in range(draw(st.integers(0, 8)))
    ]
    spend = []
    for _ in range(draw(st.integers(0, 8))):
        ad = draw(st.sampled_from(ADS))
        spend.append(cost(draw(st.sampled_from(DAYS)), ad, *product[ad], draw(money)))
    snapshots = [
        snap(draw(st.sampled_from([*DAYS, None])), draw(st.sampled_from(ADS)),
             draw(st.sampled_from([*range(-2, 7), None])),
             draw(st.integers(0, 30)), draw(st.integers(0, 30)))
        for _ in range(draw(st.integers(0, 12)))
    ]
    return sales, spend, snapshots


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(data=lakes())
def test_gold_tables_match_brute_force_on_random_lakes(spark, data):
    lake = Lake(spark, *data)
    lake.check_all()
    daily = gold.ad_daily_metrics(lake.sales, lake.spend, lake.snapshots)
    assert daily.where("alcance < 0").isEmpty()
