"""One key that owns a third of the rows: joins split it, results stay whole."""

import pytest
from pyspark.sql import functions as F

from reachmill.plans import gold, silver

# small enough that the test data counts as large
EAGER = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "40",
}
ROWS = 90_000


@pytest.fixture
def eager_splitting(spark):
    before = {k: spark.conf.get(k, None) for k in EAGER}
    for k, v in EAGER.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def rows_with_hot_key(spark, hot="hot"):
    n = F.col("id")
    other = F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(3000)))
    return spark.range(0, ROWS, 1, 8).select(
        "id",
        F.when(n % 3 == 0, hot).otherwise(other).alias("ad_id"),
        F.expr("date_add(date'2026-01-01', cast(id % 28 as int))").alias("fecha"),
    )


def spend_rows(spark, ads):
    return ads.select("ad_id").distinct().select(
        F.lit("2026-01-01").cast("date").alias("fecha"),
        "ad_id",
        F.when(F.col("ad_id") != "hot", F.col("ad_id")).otherwise("P").alias("product_id"),
        F.lit("name").alias("product_name"),
        F.lit(1).cast("decimal(10,2)").alias("daily_spend"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_ad_in_reach(spark, eager_splitting):
    base = rows_with_hot_key(spark)
    snapshots = base.select(
        "fecha", "ad_id", F.lit("ES").alias("country"),
        F.concat(F.lit("g"), F.col("id") % 9).alias("age_range"),
        (F.col("id") % 4).alias("female"), F.lit(1).cast("bigint").alias("male"),
    )
    spend = spend_rows(spark, base)
    reach = gold.demographic_reach(spend, snapshots)
    tasks = reach.where("ad_id = 'hot'").groupBy(F.spark_partition_id()).count()
    shares = [r["count"] for r in tasks.collect()]
    assert len(shares) >= 4 and max(shares) < sum(shares) / 2
    per_gender = {r[0]: r[1] for r in reach.groupBy("gender").count().collect()}
    assert per_gender == {"male": ROWS, "female": snapshots.where("female > 0").count()}
    assert reach.where("product_id is null").isEmpty()


def test_hot_ad_in_spend(spark, eager_splitting, tmp_path):
    def stored(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    base = rows_with_hot_key(spark)
    spend = stored("spend", base.select(
        "ad_id", F.col("fecha").alias("date"), F.lit(1).cast("decimal(10,2)").alias("daily_spend")
    ))
    mapping = stored("mapping", base.select(
        "ad_id", F.concat(F.lit("of "), "ad_id").alias("product_id")
    ).distinct())
    products = stored("products", mapping.select(
        "product_id", F.lit("n").alias("product_name"), F.lit(1).alias("price")
    ))
    joined = silver.ad_spend(spend, mapping, products)
    assert "skew=true" in final_plan(joined)
    assert joined.where("product_name = 'n'").count() == ROWS


def test_hot_product_in_daily_metrics(spark, eager_splitting):
    """A third of all ads promote one product, on a single day."""
    ads = spark.range(0, ROWS, 1, 8).select(F.concat(F.lit("a"), "id").alias("ad_id"), "id")
    day = F.lit("2026-01-01").cast("date")
    product = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id")))
    spend = ads.select(
        day.alias("fecha"), "ad_id", product.alias("product_id"),
        F.lit("name").alias("product_name"), F.lit(2).cast("decimal(10,2)").alias("daily_spend"),
    )
    snapshots = ads.select(
        day.alias("fecha"), "ad_id", day.alias("ad_delivery_start_time"),
        F.lit(3).cast("bigint").alias("reach"),
    )
    sales = spend.select("fecha", "product_id", "product_name").distinct().select(
        "*", F.lit(1).cast("bigint").alias("ventas_unidades"), F.lit(5.0).alias("ventas_importe")
    )
    daily = gold.ad_daily_metrics(sales, spend, snapshots)
    assert "skew=true" in final_plan(daily)
    got = daily.agg(F.count("*"), F.sum("alcance"), F.sum("ventas_unidades"), F.min("roas")).first()
    assert tuple(got) == (ROWS, 3 * ROWS, ROWS, 2.5)
