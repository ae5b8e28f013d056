"""Spend history and the snapshots it implies for past days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from reachmill.functions.dates import publication_date
from reachmill.functions.reach import scaled_breakdown, scaled_total

DEFAULT_DAYS = 30  # fixed value: length of the reconstructed period


def last_days(spark: SparkSession, today: date, days: int = DEFAULT_DAYS) -> DataFrame:
    """One row per day (fecha) of the period that ends today."""
    first = today - timedelta(days=days - 1)
    return spark.range(days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("fecha")
    )


def days_between(first_and_last: DataFrame) -> DataFrame:
    """One row per day (fecha) from a single row with columns first_day, last_day."""
    return first_and_last.select(
        F.explode(F.sequence("first_day", "last_day")).alias("fecha")
    )


def spend_per_day(days: DataFrame, spend: DataFrame) -> DataFrame:
    """Total spend of every day of the period, 0 on days without any."""
    first, last = (days.agg(bound("fecha")).scalar() for bound in (F.min, F.max))
    totals = spend.where(F.col("date").between(first, last)).groupBy(F.col("date").alias("fecha")).agg(
        F.sum("daily_spend").alias("total")
    )
    return days.join(totals, "fecha", "left").select(
        "fecha", F.coalesce("total", F.lit(0)).alias("gasto")
    )


def cumulative_share(spend_by_day: DataFrame) -> DataFrame:
    """Share of the period's spend that was reached by each day, at most 1.

    A period without positive spend counts as having spent 1 in total. The window
    has no key because its input is one row per calendar day.
    """
    until_now = Window.orderBy("fecha").rowsBetween(Window.unboundedPreceding, 0)
    period = Window.orderBy("fecha").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    total = F.sum("gasto").over(period).cast("double")
    divisor = F.when(total <= 0, F.lit(1.0)).otherwise(total)
    running = F.sum("gasto").over(until_now).cast("double")
    return spend_by_day.select(
        "fecha", "gasto", F.least(F.lit(1.0), running / divisor).alias("factor")
    )


def with_start_date(ads: DataFrame, counter: Observation | None = None) -> DataFrame:
    """Ads whose start text can be read, with it as a date column start_date.

    `counter` receives the numbers of ads seen (total) and kept.
    """
    dated = ads.withColumn("start_date", publication_date(F.col("ad_delivery_start_time")))
    if counter is not None:
        dated = dated.observe(
            counter,
            F.count(F.lit(1)).alias("total"),
            F.count("start_date").alias("kept"),
        )
    return dated.where(F.col("start_date").isNotNull())


def backcast_snapshots(ads: DataFrame, shares: DataFrame) -> DataFrame:
    """Snapshots the ads would have had on each past day of the period.

    `ads` has the landing ad fields plus start_date, see `with_start_date`; `shares`
    has fecha and factor, one row per day. An ad appears from its start date on,
    with today's reach scaled by the day's factor. The days travel as one small
    array and are exploded per ad, so ads are never shuffled.
    """
    steps = shares.agg(F.sort_array(F.collect_list(F.struct("fecha", "factor"))).alias("steps"))
    factor = F.col("step.factor")
    kept = [
        c for c in ads.columns
        if c not in ("start_date", "eu_total_reach", "age_country_gender_reach_breakdown")
    ]
    return (
        ads.withColumn("step", F.explode(steps.scalar()))
        .where(F.col("start_date") <= F.col("step.fecha"))
        .select(
            F.col("step.fecha").alias("fecha"),
            *kept,
            scaled_total(F.col("eu_total_reach"), factor).alias("eu_total_reach"),
            scaled_breakdown(F.col("age_country_gender_reach_breakdown"), factor).alias(
                "age_country_gender_reach_breakdown"
            ),
        )
    )


def product_weights(products: DataFrame, mapping: DataFrame) -> DataFrame:
    """Weight of each catalogue product: one plus the number of ads that promote it.

    Mapping rows of products outside the catalogue are ignored.
    """
    promoted = mapping.groupBy("product_id").agg(F.count(F.lit(1)).alias("ads"))
    weight = F.lit(1) + F.coalesce("ads", F.lit(0))
    return products.join(promoted, "product_id", "left").select(
        "product_id", weight.alias("weight")
    )
