"""Landing envelopes to one row per ad snapshot or sale event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.functions.dates import date_in_path, lenient_date, lenient_timestamp


def ad_snapshots(envelopes: DataFrame) -> DataFrame:
    """One row per ad of each snapshot envelope.

    The day is the extraction date; without a readable one, the dated folder the
    file was found in (column file_path).
    """
    day = F.coalesce(lenient_date(F.col("extraction_date")), date_in_path(F.col("file_path")))
    ads = envelopes.select(day.alias("fecha"), F.explode("ads").alias("ad"))
    return ads.select(
        "fecha",
        F.col("ad.id").alias("ad_id"),
        "ad.eu_total_reach",
        lenient_date(F.col("ad.ad_delivery_start_time")).alias("ad_delivery_start_time"),
        "ad.target_gender",
        "ad.target_ages",
        "ad.publisher_platforms",
        "ad.age_country_gender_reach_breakdown",
    )


def sale_events(envelopes: DataFrame) -> DataFrame:
    """One row per event of each sales envelope.

    The day is the batch date, not the event's own time: an event that arrives late
    counts on the day it was landed. Repeated deliveries are kept.
    """
    events = envelopes.select(
        lenient_date(F.col("batch_date")).alias("fecha"), F.inline("events")
    )
    return events.withColumn("timestamp", lenient_timestamp(F.col("timestamp")))


def readable() -> Column:
    """Whether an envelope was read in full; only then do its rows belong in bronze."""
    return F.col("_corrupt_record").isNull()


def unreadable(envelopes: DataFrame, body: str) -> DataFrame:
    """Envelopes that do not fit their schema in full, or have no body.

    Expects the columns file_path and _corrupt_record that the landing readers add.
    Of an envelope without a body the text is what was read of it.
    """
    without_body = F.col(body).isNull()
    read = F.to_json(F.struct(*(c for c in envelopes.columns if c not in ("file_path", "_corrupt_record"))))
    text = F.coalesce("_corrupt_record", read).alias("_corrupt_record")
    return envelopes.where(~readable() | without_body).select("file_path", text)
