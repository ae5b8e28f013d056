"""Silver tables: daily sales, spend with its product, demographic snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.ratios import money_sum


def daily_sales(sale_events: DataFrame) -> DataFrame:
    """Units and amount per day and product. Events without a day are left out."""
    return (
        sale_events.where(F.col("fecha").isNotNull())
        .groupBy("fecha", "product_id", "product_name")
        .agg(
            F.sum("quantity").alias("ventas_unidades"),
            money_sum(sale_events, "total_amount").alias("ventas_importe"),
        )
    )


def ad_spend(spend: DataFrame, mapping: DataFrame, products: DataFrame) -> DataFrame:
    """Spend rows with the product their ad promotes; unmapped ads keep null.

    Mapping and products are joined first. Both are one row per key, so the large
    table, spend, is shuffled once instead of twice, and its unmapped rows never
    meet in one task as null product ids.
    """
    promoted = mapping.select("ad_id", "product_id").join(
        products.select("product_id", "product_name", "price"), "product_id", "left"
    )
    return spend.join(promoted, "ad_id", "left").select(
        F.col("date").alias("fecha"),
        "ad_id",
        "product_id",
        "product_name",
        "price",
        "daily_spend",
    )


def demographic_snapshots(ad_snapshots: DataFrame) -> DataFrame:
    """One row per ad, day, country and age range.

    Reach is female plus male; the unknown count is not part of it. Ads without a
    breakdown have no rows here.
    """
    ad_columns = [
        "fecha", "ad_id", "eu_total_reach", "ad_delivery_start_time",
        "target_gender", "target_ages", "publisher_platforms",
    ]
    by_country = ad_snapshots.select(
        *ad_columns, F.inline("age_country_gender_reach_breakdown")
    )
    by_age = by_country.select(*ad_columns, "country", F.inline("age_gender_breakdowns"))
    counts = by_age.select(
        *ad_columns,
        "country",
        "age_range",
        F.coalesce("female", F.lit(0)).alias("female"),
        F.coalesce("male", F.lit(0)).alias("male"),
    )
    return counts.withColumn("reach", F.col("female") + F.col("male"))
