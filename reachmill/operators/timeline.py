"""Ads over time: which days they were live, what each day added.

All functions take the silver tables and use these of their columns:
snapshots (fecha, ad_id, ad_delivery_start_time, reach) and
spend (fecha, ad_id, product_id, product_name, daily_spend).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachmill.functions.ratios import money_sum
from reachmill.operators.adstate import ad_state, grown


def observed_days(snapshots: DataFrame) -> DataFrame:
    """One row, one sorted array: every day that has a snapshot of any ad.

    At most one entry per calendar day whatever the number of rows, so it is safe
    to hold as a single value. Null days are left out.
    """
    days = snapshots.select("fecha").distinct()
    return days.agg(F.array_sort(F.collect_list("fecha")).alias("days"))


def calendar(snapshots: DataFrame) -> DataFrame:
    """One row, one struct: the observed days, the first of them, and for every calendar day
    from it on the number of days observed so far.

    With it a day's place among the observed days is one look-up, however long the history.
    The arrays have one entry per calendar day: ten years are some 30 kB.
    """
    gap = lambda day, i: F.coalesce(F.datediff(F.get("days", i + 1), day), F.lit(1))
    upto = F.flatten(F.transform("days", lambda day, i: F.array_repeat(i + 1, gap(day, i))))
    first = F.get("days", F.lit(0)).alias("first")
    return observed_days(snapshots).select(F.struct("days", first, upto.alias("upto")).alias("calendar"))


def ad_starts(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("ad_id").agg(
        F.min("ad_delivery_start_time").alias("fecha_inicio_anuncio")
    )


def ad_product(spend: DataFrame) -> DataFrame:
    """One product per ad.

    Should an ad have several, the smallest product_id wins, and a known product
    wins over none, so that reruns agree.
    """
    known = F.when(F.col("product_id").isNotNull(), F.struct("product_id", "product_name"))
    return (
        spend.groupBy("ad_id")
        .agg(F.min(known).alias("product"))
        .select("ad_id", "product.product_id", "product.product_name")
    )


def active_grid(snapshots: DataFrame, spend: DataFrame) -> DataFrame:
    """Every observed day of every ad from the ad's start on, with its product.

    The days come in as one array value and are exploded per ad: no cross join and
    no shuffle of the grid. An ad without a start date has no active days.
    """
    return (
        ad_starts(snapshots)
        .join(ad_product(spend), "ad_id", "left")
        .withColumn("fecha", F.explode(_from_start(calendar(snapshots).scalar())))
        .select("fecha", "ad_id", "product_id", "product_name", "fecha_inicio_anuncio")
    )


def _days_before(known: Column, day: Column) -> Column:
    """Number of observed days before a day."""
    upto = F.get(known["upto"], F.datediff(day, known["first"]) - 1)
    return F.when(day <= known["first"], 0).otherwise(F.coalesce(upto, F.size(known["days"])))


def _from_start(known: Column) -> Column:
    """The observed days from an ad's start on; none without a start."""
    start = F.col("fecha_inicio_anuncio")
    seen = _days_before(known, start)
    rest = F.slice(known["days"], seen + 1, F.greatest(F.size(known["days"]) - seen, F.lit(0)))
    return F.when(start.isNotNull(), rest)


def reach_deltas(snapshots: DataFrame, spend: DataFrame) -> DataFrame:
    """New reach of every ad and snapshot day, undated ones included.

    Snapshots are cumulative. The first counts in full; after that the difference
    to the previous snapshot row of the ad counts, however many days lie between,
    and a fall counts as 0. Two snapshots of one day are added together.
    """
    return ad_state(snapshots, spend).select("ad_id", F.inline(grown(F.col("days")))).select(
        "fecha", "ad_id", F.col("added").alias("alcance")
    )


def spend_by_ad_day(spend: DataFrame) -> DataFrame:
    return spend.groupBy("fecha", "ad_id").agg(
        money_sum(spend, "daily_spend").alias("gasto")
    )


def ad_days(snapshots: DataFrame, spend: DataFrame) -> DataFrame:
    """The active grid with each day's spend and reach already on it.

    Same rows and values as `active_grid` left-joined with `spend_by_ad_day` and
    `reach_deltas`, without those joins. Snapshots and spend are first reduced
    together to one row per ad and day, then one window per ad works out start,
    reach growth and the stretch of days the row stands for: its own day plus the
    observed days up to the ad's next row. The product joins in while the rows are
    still in window order, and exploding the stretches then fills the gaps. Both
    tables are reduced map-side before they are shuffled, and the grid itself comes
    into being after the last shuffle.
    """
    known = calendar(snapshots).scalar()
    facts = _facts(snapshots, spend, known)

    by_day = Window.partitionBy("ad_id").orderBy("fecha")
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    last_snapshot = F.when(F.col("is_snapshot"), F.struct("alcance_acumulado"))

    per_ad = facts.withColumns(
        {
            "fecha_inicio_anuncio": F.min("start").over(whole),
            "previous": F.last(last_snapshot, ignorenulls=True).over(before),
            "next_pos": F.lead("pos").over(by_day),
            "is_first": F.lag("is_snapshot").over(by_day).isNull(),
        }
    )

    # The ad's first row also stands for the days between its start and that row; an
    # undated snapshot sorts first, has no position, and stands for nothing else.
    # The list of days stays a single value: it is never copied into the rows.
    all_days, start = known["days"], F.col("fecha_inicio_anuncio")
    start_pos = _days_before(known, start) + 1
    first_pos = F.when(F.col("is_first"), F.least("pos", start_pos.cast("int"))).otherwise(
        F.col("pos")
    )
    end_pos = F.coalesce("next_pos", F.size(all_days) + 1)
    length = F.greatest(end_pos - first_pos, F.lit(0))
    stretch = (
        per_ad.where(start.isNotNull())
        .join(ad_product(spend), "ad_id", "left")
        .withColumn("day", F.explode(F.slice(all_days, first_pos, length)))
        .where(F.col("day") >= start)
    )

    # a row without ad id is on the grid, but no spend or reach can be joined to it
    own = (F.col("day") == F.col("fecha")) & F.col("ad_id").isNotNull()
    growth = F.when(
        F.col("is_snapshot"), _growth("alcance_acumulado", "previous.alcance_acumulado")
    )
    return stretch.select(
        F.col("day").alias("fecha"),
        "ad_id",
        "product_id",
        "product_name",
        "fecha_inicio_anuncio",
        F.when(own, F.col("gasto")).alias("gasto"),
        F.when(own, growth).alias("alcance"),
    )


def _facts(snapshots: DataFrame, spend: DataFrame, known: Column) -> DataFrame:
    """One row per ad and day that has a snapshot or, on an observed day, spend.

    `pos` is the day's position among the observed days.
    """
    money = spend.schema["daily_spend"].dataType
    from_snapshots = snapshots.select(
        "ad_id",
        "fecha",
        F.col("ad_delivery_start_time").alias("start"),
        "reach",
        F.lit(None).cast(money).alias("daily_spend"),
        F.lit(True).alias("is_snapshot"),
    )
    from_spend = spend.select(
        "ad_id",
        "fecha",
        F.lit(None).cast("date").alias("start"),
        F.lit(None).cast("bigint").alias("reach"),
        "daily_spend",
        F.lit(False).alias("is_snapshot"),
    )
    place = F.get(known["upto"], F.datediff("fecha", known["first"]))
    return (
        from_snapshots.unionByName(from_spend)
        .groupBy("ad_id", "fecha")
        .agg(
            F.min("start").alias("start"),
            F.sum("reach").alias("alcance_acumulado"),
            money_sum(spend, "daily_spend").alias("gasto"),
            F.max("is_snapshot").alias("is_snapshot"),
        )
        .withColumn("pos", F.when(F.get(known["days"], place - 1) == F.col("fecha"), place))
        .where("is_snapshot or pos > 0")
    )


def _growth(current: str, previous: str):
    cur, prev = F.col(current), F.col(previous)
    return F.when(prev.isNull(), cur).otherwise(F.greatest(cur - prev, F.lit(0)))
