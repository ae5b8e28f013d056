"""From dumped API pages and landing files to the ads of one snapshot."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.functions.dates import utc_date, utc_iso


def assemble_pages(pages: DataFrame, extracted_at: datetime | Column) -> DataFrame:
    """All ads of the pages as rows of one snapshot, stamped with date, time and count.

    The number of ads is computed as a single value next to the rows; the ads are
    not gathered into one array. Pages without data add nothing.
    """
    moment = extracted_at if isinstance(extracted_at, Column) else F.lit(extracted_at)
    ads_on_page = F.greatest(F.coalesce(F.size("data"), F.lit(0)), F.lit(0))
    total = pages.agg(F.coalesce(F.sum(ads_on_page), F.lit(0)).cast("bigint").alias("n"))
    return pages.select(F.inline("data")).select(
        utc_date(moment).alias("extraction_date"),
        utc_iso(moment).alias("extraction_timestamp"),
        total.scalar().alias("total_ads"),
        "*",
    )


def raw_ads(pages: DataFrame, extracted_at: datetime | Column) -> DataFrame:
    """The same for ads as received: column `ad` is the text of one, with all its fields."""
    ads = assemble_pages(pages.select(F.transform("data", lambda ad: F.struct(ad.alias("ad"))).alias("data")), extracted_at)
    return ads.select("extraction_date", "extraction_timestamp", "total_ads", "ad")


def latest_snapshot(envelopes: DataFrame) -> DataFrame:
    """The ads of the envelopes whose file_path is last in text order.

    For files still in landing, `sources.landing.newest_snapshot` finds that path
    from the listing alone.
    """
    newest = envelopes.agg(F.max("file_path").alias("file_path")).scalar()
    return envelopes.where(F.col("file_path") == newest).select("file_path", F.inline("ads"))


def ad_ids(ads: DataFrame) -> DataFrame:
    return ads.select(F.col("id").alias("ad_id"))


def in_time_order(events: Column) -> Column:
    """An envelope's event array sorted by event time, ties by event id."""

    def earlier_first(a: Column, b: Column) -> Column:
        left, right = (F.struct(e["timestamp"], e["event_id"]) for e in (a, b))
        return F.when(left < right, -1).when(left > right, 1).otherwise(0)

    return F.array_sort(events, earlier_first)
