"""What is known of every ad, one row an ad, and what a change of some days does to the rest.

A row of the state holds, besides the ad_id,

* days: the ad's snapshot days in order, each with its cumulative reach and earliest start;
* products: the days on which spend named a product, each with the smallest of them.

An ad has an entry for each calendar day at most, of some twenty bytes: ten years are 73 kB,
while the snapshots behind one entry are a row for each country and age range. Start,
product, growth and the neighbours of a day all follow from the row, so a run over some days
reads these days and the state, and nothing else of history.

A changed day has effects outside itself: growth on the ad's next snapshot day, and, where
the ad's start or product changes, all days of the ad. `touched` names these rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.functions.dates import in_days

DAY = "struct<fecha: date, reach: bigint, start: date>"
PRODUCT = "struct<fecha: date, product: struct<product_id: string, product_name: string>>"


def ad_state(snapshots: DataFrame, spend: DataFrame) -> DataFrame:
    """The state that snapshots and spend of some days, or of all, amount to.

    Both tables are reduced together, map-side, to a row for each ad and day before an ad's
    days meet. Spend without an ad id names no ad's product.
    """
    known = F.when(F.col("product_id").isNotNull(), F.struct("product_id", "product_name"))
    from_snapshots = snapshots.select(
        "ad_id", "fecha", F.col("ad_delivery_start_time").alias("start"), "reach", F.lit(True).alias("is_snapshot")
    )
    from_spend = spend.where("ad_id is not null and product_id is not null").select("ad_id", "fecha", known.alias("product"))
    by_day = from_snapshots.unionByName(from_spend, allowMissingColumns=True).groupBy("ad_id", "fecha").agg(
        F.min("start").alias("start"),
        F.sum("reach").alias("reach"),
        F.max("is_snapshot").alias("is_snapshot"),
        F.min("product").alias("product"),
    )
    day = F.when(F.col("is_snapshot"), F.struct("fecha", "reach", "start"))
    paid = F.when(F.col("product").isNotNull(), F.struct("fecha", "product"))
    return by_day.groupBy("ad_id").agg(
        F.sort_array(F.collect_list(day)).cast(f"array<{DAY}>").alias("days"),
        F.sort_array(F.collect_list(paid)).cast(f"array<{PRODUCT}>").alias("products"),
    )


def merged(state: DataFrame, fresh: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """The state with the days of a range replaced by those of `fresh`, each row with the one
    it replaces in `before`. Ads that have no day any more keep an empty row."""
    stays = lambda entry: ~F.coalesce(in_days(start, end, entry["fecha"]) & entry["fecha"].isNotNull(), F.lit(False))
    old = state.select(
        "ad_id",
        F.filter("days", stays).alias("days"),
        F.filter("products", stays).alias("products"),
        F.struct("days", "products").alias("before"),
    )
    both = old.unionByName(fresh, allowMissingColumns=True)
    return both.groupBy("ad_id").agg(
        F.sort_array(F.flatten(F.collect_list("days"))).alias("days"),
        F.sort_array(F.flatten(F.collect_list("products"))).alias("products"),
        F.first("before", ignorenulls=True).alias("before"),
    )


def started(days: Column) -> Column:
    return F.array_min(F.transform(days, lambda d: d["start"]))


def promoted(products: Column) -> Column:
    """The smallest product of an ad, as `timeline.ad_product` takes it."""
    return F.array_min(F.transform(products, lambda p: p["product"]))


def grown(days: Column) -> Column:
    """What each snapshot added to the one before; the first counts in full, a fall as 0."""

    def growth(day: Column, place: Column) -> Column:
        previous = F.get(days, place - 1)["reach"]
        added = F.when(previous.isNull(), day["reach"]).otherwise(F.greatest(day["reach"] - previous, F.lit(0)))
        return F.struct(day["fecha"].alias("fecha"), added.alias("added"))

    return F.transform(days, growth)


def observed_days(state: DataFrame) -> DataFrame:
    """One row, one array: the days on which any ad has a snapshot."""
    days = state.select(F.explode("days").alias("day")).where("day.fecha is not null").select("day.fecha").distinct()
    return days.agg(F.array_sort(F.collect_list("fecha")).alias("days"))


def touched(changed: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """The rows of the daily table that a replaced range of days has touched.

    One row for each ad and day: ad_id, fecha, product_id, product_name,
    fecha_inicio_anuncio, alcance (null without a snapshot), is_active (False: the table has
    this row no more) and new_product. `changed` is the result of `merged`, as a written
    table. Of every ad these are the observed days of the range; the days outside it on which
    its growth is another one; and all its days, if its start or product is another one.
    """
    before, observed = F.col("before"), F.col("observed")
    per_ad = changed.select(
        "ad_id",
        started(F.col("days")).alias("start"),
        started(before["days"]).alias("old_start"),
        promoted(F.col("products")).alias("product"),
        promoted(before["products"]).alias("old_product"),
        grown(F.col("days")).alias("growth"),
        F.coalesce(grown(before["days"]), F.array().cast("array<struct<fecha: date, added: bigint>>")).alias("old_growth"),
        observed_days(changed).scalar().alias("observed"),
    )
    inside = lambda day: F.coalesce(in_days(start, end, day), F.lit(False))
    other_product = ~F.col("product").eqNullSafe(F.col("old_product"))
    other = ~F.col("start").eqNullSafe(F.col("old_start")) | (other_product & F.col("ad_id").isNotNull())
    since = F.least("start", "old_start")
    life = F.filter(observed, lambda d: d >= since)
    moved = F.transform(F.array_except("growth", "old_growth"), lambda g: g["fecha"])
    some = F.filter(observed, lambda d: (d >= F.col("start")) & (inside(d) | F.array_contains(moved, d)))
    dated = F.filter("growth", lambda g: g["fecha"].isNotNull())
    rows = per_ad.select(
        "ad_id",
        "start",
        F.when(F.col("ad_id").isNotNull(), F.col("product")).alias("product"),
        F.when(F.col("ad_id").isNotNull(), F.map_from_entries(dated)).alias("added"),
        (other_product & F.col("ad_id").isNotNull()).alias("new_product"),
        F.explode(F.when(other, life).otherwise(some)).alias("fecha"),
    )
    return rows.select(
        "ad_id",
        "fecha",
        "product.product_id",
        "product.product_name",
        F.col("start").alias("fecha_inicio_anuncio"),
        F.try_element_at("added", "fecha").alias("alcance"),
        F.coalesce(F.col("fecha") >= F.col("start"), F.lit(False)).alias("is_active"),
        "new_product",
    )
