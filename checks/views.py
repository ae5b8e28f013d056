"""Campaign tables derived from the driver's tables.

A user is an ad. Every third one promotes part 0, the others the part of their number modulo
the number of parts; the product table lacks every 25th part on purpose. Clicks are spend, purchases are
sales, views and errors are reach; even event ids count as female, odd ones as male.
Ids become text, as they are in the campaign tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NATIONS = 25  # fixed value: rows of nation


class Views:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("fecha", F.col("ts").cast("date"))

    @cached_property
    def _product_of_user(self) -> Column:
        parts = self.table("part").agg(F.count(F.lit(1)).alias("n")).scalar()
        return F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") % parts)

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").where("p_partkey % 25 <> 24").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )

    @cached_property
    def mapping(self) -> DataFrame:
        return (
            self.events.where("user_id % 10 <> 9")
            .select("user_id")
            .distinct()
            .select(
                F.col("user_id").cast("string").alias("ad_id"),
                self._product_of_user.cast("string").alias("product_id"),
            )
        )

    @cached_property
    def spend(self) -> DataFrame:
        amount = F.sum(F.col("value").cast("decimal(18,2)"))
        return (
            self.events.where("event_type = 'click'")
            .groupBy(F.col("user_id").cast("string").alias("ad_id"), F.col("fecha").alias("date"))
            .agg(amount.cast("decimal(10,2)").alias("daily_spend"))
        )

    @cached_property
    def sale_events(self) -> DataFrame:
        parts = self.table("part").select("p_partkey", "p_name", "p_retailprice")
        purchases = self.events.where("event_type = 'purchase'").withColumn(
            "p_partkey", self._product_of_user
        )
        return purchases.join(parts, "p_partkey").select(
            "fecha",
            F.col("event_id").cast("string").alias("event_id"),
            "ts",
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            (1 + F.col("event_id") % 3).alias("quantity"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("value").cast("decimal(18,2)").alias("total_amount"),
            F.concat(F.lit("zone "), F.col("user_id") % 5).alias("region"),
            F.lit("ecommerce").alias("channel"),
        )

    @cached_property
    def flat_snapshots(self) -> DataFrame:
        """Cumulative counts on the days that have events, so gaps and dips occur."""
        nation = self.table("nation").select("n_nationkey", "n_name")  # fixed, 25 rows
        daily = (
            self.events.where("event_type in ('view', 'error')")
            .groupBy("fecha", "user_id", F.col("event_type").alias("age_range"))
            .agg(
                F.sum(F.when(F.col("event_id") % 2 == 0, 1).otherwise(0)).alias("f"),
                F.sum(F.when(F.col("event_id") % 2 == 1, 1).otherwise(0)).alias("m"),
            )
        )
        ad = Window.partitionBy("user_id")
        running = Window.partitionBy("user_id", "age_range").orderBy("fecha")
        on_nation = (F.col("user_id") % NATIONS).cast("int") == F.col("n_nationkey")
        return (
            daily.withColumns(
                {
                    "female": F.sum("f").over(running),
                    "male": F.sum("m").over(running),
                    "ad_delivery_start_time": F.min("fecha").over(ad),
                }
            )
            .join(nation, on_nation)
            .select(
                "fecha",
                F.col("user_id").cast("string").alias("ad_id"),
                "ad_delivery_start_time",
                F.col("n_name").alias("country"),
                "age_range",
                "female",
                "male",
                (F.col("female") + F.col("male")).alias("reach"),
            )
        )

    @cached_property
    def nested_snapshots(self) -> DataFrame:
        """The same rows as one nested ad per day, the way the ads API delivers them.

        A group holds the countries and age ranges of one ad on one day, two rows at
        the most.
        """
        ages = F.collect_list(
            F.struct("age_range", "female", "male", F.lit(1).cast("bigint").alias("unknown"))
        )
        per_country = self.flat_snapshots.groupBy(
            "fecha", "ad_id", "ad_delivery_start_time", "country"
        ).agg(ages.alias("age_gender_breakdowns"), F.sum("reach").alias("reach"))
        countries = F.collect_list(F.struct("country", "age_gender_breakdowns"))
        return (
            per_country.groupBy("fecha", "ad_id", "ad_delivery_start_time")
            .agg(
                countries.alias("age_country_gender_reach_breakdown"),
                F.sum("reach").alias("eu_total_reach"),
            )
            .withColumns(
                {
                    "target_gender": F.lit("All"),
                    "target_ages": F.array(F.lit("18"), F.lit("65")),
                    "publisher_platforms": F.array(F.lit("site"), F.lit("app")),
                }
            )
        )
