"""Jobs: into landing, and from landing to gold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reachmill import contracts as names
from reachmill.functions.dates import dated_folder, in_days, on_days
from reachmill.operators import extraction, history
from reachmill.operators.adstate import ad_state, merged, promoted, touched
from reachmill.operators.timeline import spend_by_ad_day
from reachmill.plans import bronze, gold, silver
from reachmill.sinks.landing import (
    backcast_envelopes,
    raw_snapshot_lines,
    write_envelopes,
    write_lines,
)
from reachmill.sinks.files import Files
from reachmill.sinks.staged import Staging, Target, outside
from reachmill.sinks.tables import gold_target, laid_out_by_day, register, silver_target
from reachmill.sources.files import read_raw_pages, read_stored
from reachmill.sources.landing import CORRUPT, newest_snapshot, read_entry
from reachmill.sources.ledger import FILES_PER_BATCH
from reachmill.streaming.ingest import Ingested, ingest


@dataclass(frozen=True)
class Lake:
    """A lake's root folder and the format of its tables."""

    root: str
    table_format: str = "parquet"

    def path(self, layer: str, dataset: str) -> str:
        return f"{self.root}/{layer}/{dataset}"

    def read(
        self,
        spark: SparkSession,
        layer: str,
        dataset: str,
        start: date | None = None,
        end: date | None = None,
    ) -> DataFrame:
        return read_stored(spark, self.path(layer, dataset), self.table_format, start, end)


def snapshot_to_landing(
    spark: SparkSession, lake: Lake, pages_folder: str, extracted_at: datetime
) -> str:
    """Land the dumped pages of one ads API extraction as a snapshot; returns its path.

    Ads are landed as received, with fields this package does not know. A page that is
    cut off ends the job before anything is landed: a snapshot without its ads would
    pass for one on which they did not grow.
    """
    moment = extracted_at.astimezone(timezone.utc)
    folder = dated_folder(names.LANDING, names.SNAPSHOTS, moment.date())
    path = f"{lake.root}/{folder}/{names.SNAPSHOTS}_{moment:%Y%m%d_%H%M%S}"
    pages = read_raw_pages(spark, pages_folder)
    torn = pages.where(F.col(CORRUPT).isNotNull()).agg(
        F.count(F.lit(1)).alias("pages"), F.min("file_path").alias("first")
    ).first()
    if torn["pages"]:
        raise ValueError(f"{torn['pages']} unreadable pages, the first of them {torn['first']}")
    write_lines(raw_snapshot_lines(extraction.raw_ads(pages, moment)), path)
    return path


def backcast_to_landing(
    spark: SparkSession,
    lake: Lake,
    spend: DataFrame,
    today: date,
    days: int = history.DEFAULT_DAYS,
) -> str:
    """Land the snapshots that the newest one implies for the last days; returns the path.

    The folder is not named like a snapshot, so it is never taken for the newest one.
    """
    newest = newest_snapshot(spark, lake.path(names.LANDING, names.SNAPSHOTS), names.SNAPSHOTS)
    if newest is None:
        raise FileNotFoundError(f"no snapshot in {lake.path(names.LANDING, names.SNAPSHOTS)}")
    ads = read_entry(spark, newest, names.SNAPSHOT_ENVELOPE).select(F.inline("ads"))
    if ads.isEmpty():
        raise ValueError(f"no ads in {newest}")
    period = history.last_days(spark, today, days)
    shares = history.cumulative_share(history.spend_per_day(period, spend))
    past = history.backcast_snapshots(history.with_start_date(ads), shares)
    folder = dated_folder(names.LANDING, names.SNAPSHOTS, today)
    path = f"{lake.root}/{folder}/backcast_{today:%Y%m%d}"
    write_envelopes(backcast_envelopes(past), path)
    return path


def landing_to_bronze(
    spark: SparkSession, lake: Lake, max_files: int = FILES_PER_BATCH, archive: bool = False
) -> dict[str, Ingested]:
    """Ingest new landing files of both datasets, one after the other.

    Every record ends up in bronze or, with its text, under `quarantine`. With `archive`
    read files leave landing, see `streaming.ingest`.
    """
    datasets: dict[str, tuple[str, str, Callable[[DataFrame], DataFrame]]] = {
        names.SNAPSHOTS: (names.SNAPSHOT_ENVELOPE, "ads", bronze.ad_snapshots),
        names.SALES: (names.SALES_ENVELOPE, "events", bronze.sale_events),
    }
    return {
        dataset: ingest(
            spark, lake.root, dataset, schema, body, flatten, lake.table_format, max_files, archive
        )
        for dataset, (schema, body, flatten) in datasets.items()
    }


class Written(dict):
    """Rows written per table. `read` has the rows of the relational inputs, as counted by the
    same run; None for an input that Spark found it need not read."""

    read: dict[str, int | None]


def _counted(df: DataFrame, columns: list[str], counter: Observation) -> DataFrame:
    """The needed columns of an input, counted as they are read. What is counted first is
    what reaches the source, so columns and days have to be chosen before."""
    return df.select(*columns).observe(counter, F.count(F.lit(1)).alias("rows"))


def _rows(counter: Observation) -> int | None:
    try:
        return counter.get["rows"]
    except Py4JError:
        return None


def bronze_to_silver(
    spark: SparkSession,
    lake: Lake,
    spend: DataFrame,
    mapping: DataFrame,
    products: DataFrame,
    start: date | None = None,
    end: date | None = None,
) -> Written:
    """Rebuild the silver tables; returns rows written per table, and rows read.

    With `start` or `end` only these days are read, worked out and replaced; days that
    have no rows any more are removed. Rows without a day are taken up by runs over all
    days only. All three tables are written before the first of them is put in place.
    """
    days = None if start is None and end is None else (start, end)
    sales = silver.daily_sales(lake.read(spark, names.BRONZE, names.SALES, start, end))
    snapshots = silver.demographic_snapshots(
        lake.read(spark, names.BRONZE, names.SNAPSHOTS, start, end)
    )
    counters = {name: Observation() for name in (names.SQL_SPEND, names.SQL_MAPPING, names.SQL_PRODUCTS)}
    spent, mapped, sold = counters.values()
    spend = _counted(spend.where(in_days(start, end, "date")), ["ad_id", "date", "daily_spend"], spent)
    mapping = _counted(mapping, ["ad_id", "product_id"], mapped)
    products = _counted(products, ["product_id", "product_name", "price"], sold)
    # snapshots come row by row from a table already laid out by day
    tables = {
        names.SILVER_SALES: (sales, True),
        names.SILVER_SPEND: (silver.ad_spend(spend, mapping, products), True),
        names.SILVER_SNAPSHOTS: (snapshots, False),
    }
    staging = Staging(spark, f"{lake.root}/.silver-next")
    written = Written(
        {
            name: staging.add(
                laid_out_by_day(df, rebalance),
                silver_target(lake.path(names.SILVER, name), lake.table_format, days),
            )
            for name, (df, rebalance) in tables.items()
        }
    )
    staging.commit()
    written.read = {name: _rows(counter) for name, counter in counters.items()}
    return written


#: What the gold job keeps for its next run.
STATE, AD_STATE, TOTAL_PARTS = "state", "ads", "ad_totals"


def silver_to_gold(
    spark: SparkSession,
    lake: Lake,
    schema: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> dict[str, int]:
    """Rebuild the gold tables; returns rows written per table.

    With `schema` ("schema" or "catalog.schema") the tables are registered there too.

    With `start` or `end` only these days of silver are read and replaced, and gold is
    then what a run over all days would make it, on every day: the state of each ad
    (`operators.adstate`) tells which other rows the change touches, and only their days
    are read and written besides. Totals are carried on by taking back the rows that go
    and adding those that come. Of history such a run reads the state, a row an ad.
    A lake without state or gold starts with the range alone.

    All tables are written before the first is put in place, and all are put in place by
    one commit, so that a run that fails can be repeated: it finds gold and state of one
    and the same earlier run.
    """
    staging = Staging(spark, f"{lake.root}/.gold-next")
    if start is None and end is None:
        written = _all_gold(spark, lake, staging)
    else:
        written = _gold_of_days(spark, lake, staging, start, end)
    staging.commit()
    if schema:
        for name in written:
            register(spark, f"{schema}.{name}", lake.path(names.GOLD, name), lake.table_format)
    return written


def _all_gold(spark: SparkSession, lake: Lake, staging: Staging) -> dict[str, int]:
    sales, spend, snapshots = (
        lake.read(spark, names.SILVER, name)
        for name in (names.SILVER_SALES, names.SILVER_SPEND, names.SILVER_SNAPSHOTS)
    )
    place = lambda name, by_day=False: gold_target(lake.path(names.GOLD, name), lake.table_format, by_day)
    daily = gold.ad_daily_metrics(sales, spend, snapshots)
    written = {names.GOLD_AD_DAILY: staging.add(daily.hint("rebalance", "fecha"), place(names.GOLD_AD_DAILY, True))}
    parts = staging.keep(gold.total_parts(staging.read(0, daily.schema)), "parts")
    written[names.GOLD_AD_TOTAL] = staging.add(gold.totals_of(parts, daily), place(names.GOLD_AD_TOTAL))
    reach = gold.demographic_reach(spend, snapshots).hint("rebalance", "fecha")
    written[names.GOLD_REACH] = staging.add(reach, place(names.GOLD_REACH, True))
    written[names.GOLD_SATURATION] = staging.add(gold.saturation_curve(sales, spend), place(names.GOLD_SATURATION))
    staging.add(parts, Target(lake.path(STATE, TOTAL_PARTS), []))
    staging.add(ad_state(snapshots, spend), Target(lake.path(STATE, AD_STATE), []))
    return written


def _gold_of_days(
    spark: SparkSession, lake: Lake, staging: Staging, start: date | None, end: date | None
) -> dict[str, int]:
    silver_then = {
        name: lake.read(spark, names.SILVER, name, start, end)
        for name in (names.SILVER_SALES, names.SILVER_SPEND, names.SILVER_SNAPSHOTS)
    }
    sales, spend, snapshots = silver_then.values()
    fresh = ad_state(snapshots, spend)
    known = _stored(spark, lake, STATE, AD_STATE)
    if known is None and _stored(spark, lake, names.GOLD, names.GOLD_AD_DAILY) is not None:
        return _all_gold(spark, lake, staging)
    known = fresh.limit(0) if known is None else known
    changed = staging.keep(merged(known, fresh, start, end), "changed")
    rows = staging.keep(touched(changed, start, end), "touched")
    within = F.coalesce(in_days(start, end), F.lit(False))
    elsewhere = _days(rows.where(~within))

    def on_those_days(name: str) -> DataFrame:
        stored = lake.read(spark, names.SILVER, name)
        return silver_then[name].unionByName(stored.where(on_days(elsewhere, True) & ~within))

    def besides(name: str, days: list[date]) -> DataFrame | None:
        """Gold rows of the range and of some other days."""
        stored = _stored(spark, lake, names.GOLD, name)
        return None if stored is None else stored.where(within | on_days(days))

    # daily metrics: what is touched anew, what else those days have as it is
    spent = spend_by_ad_day(on_those_days(names.SILVER_SPEND))
    active = rows.where("is_active").join(spent, ["fecha", "ad_id"], "left")
    daily = staging.keep(gold.daily_metrics(active, on_those_days(names.SILVER_SALES)), "daily")
    stored, stays = besides(names.GOLD_AD_DAILY, elsewhere), daily.limit(0)
    gone = daily.limit(0)
    if stored is not None:
        stored = stored.select(*daily.columns)
        key = rows.select(F.col("fecha").alias("day"), F.col("ad_id").alias("ad"))
        same = (F.col("fecha") == F.col("day")) & F.col("ad_id").eqNullSafe(F.col("ad"))
        others = stored.where(~within)
        stays = others.join(key, same, "left_anti")
        gone = stored.where(within).unionByName(others.join(key, same, "left_semi"))

    place = lambda name, days=None, also=(): gold_target(
        lake.path(names.GOLD, name), lake.table_format, days is not None, days, also
    )
    whole = daily.unionByName(stays).hint("rebalance", "fecha")
    written = {names.GOLD_AD_DAILY: staging.add(whole, place(names.GOLD_AD_DAILY, (start, end), elsewhere))}

    # totals: the parts so far, less what went, and what came
    parts = [gold.total_parts(gone, -1), gold.total_parts(daily)]
    so_far = _stored(spark, lake, STATE, TOTAL_PARTS)
    parts = staging.keep(gold.merged_parts(*([] if so_far is None else [so_far]), *parts), "parts")
    written[names.GOLD_AD_TOTAL] = staging.add(gold.totals_of(parts, daily), place(names.GOLD_AD_TOTAL))
    staging.add(parts, Target(lake.path(STATE, TOTAL_PARTS), []))

    # reach: the range anew, and the other days of ads whose product is another one
    products = changed.where("ad_id is not null").select("ad_id", promoted(F.col("products")).alias("product"))
    products = products.select("ad_id", "product.product_id", "product.product_name")
    relabelled = rows.where("new_product").select("ad_id").distinct()
    shown = changed.join(relabelled, "ad_id", "left_semi").select(F.explode("days.fecha").alias("fecha"))
    elsewhere = _days(shown.where(F.col("fecha").isNotNull() & ~within))
    reach = gold.demographic_reach(spend, snapshots, products)
    stored = besides(names.GOLD_REACH, elsewhere) if elsewhere else None
    if stored is not None:
        others = stored.where(~within)
        named = others.drop("product_id", "product_name").join(products.join(relabelled, "ad_id", "left_semi"), "ad_id")
        others = others.join(relabelled, "ad_id", "left_anti").unionByName(named)
        reach = reach.unionByName(others.select(*reach.columns))
    written[names.GOLD_REACH] = staging.add(
        reach.hint("rebalance", "fecha"), place(names.GOLD_REACH, (start, end), elsewhere)
    )

    # the curve has a row a day
    curve = gold.saturation_curve(sales, spend)
    stored = _stored(spark, lake, names.GOLD, names.GOLD_SATURATION)
    if stored is not None:
        curve = curve.unionByName(outside(stored, start, end))
    written[names.GOLD_SATURATION] = staging.add(curve, place(names.GOLD_SATURATION))
    kept = changed.where("size(days) > 0 or size(products) > 0").drop("before")
    staging.add(kept, Target(lake.path(STATE, AD_STATE), []))
    return written


def _stored(spark: SparkSession, lake: Lake, layer: str, dataset: str) -> DataFrame | None:
    """A table of an earlier run, None if there is none. The state is parquet in any lake."""
    path = lake.path(layer, dataset)
    if not Files(spark).exists(path):
        return None
    return spark.read.parquet(path) if layer == STATE else lake.read(spark, layer, dataset)


def _days(rows: DataFrame) -> list[date]:
    """The days of some rows: at most one value per calendar day."""
    return sorted(r["fecha"] for r in rows.select("fecha").distinct().collect())
