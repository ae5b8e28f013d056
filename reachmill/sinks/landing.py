"""Landing output: JSON lines, one small envelope per line.

An envelope here holds exactly one ad or one event. That keeps the envelope format
readers expect while the writing needs no grouping: no shuffle, no array that grows
with the batch, and files any number of tasks can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.functions.dates import utc_date, utc_iso


def sales_envelopes(events: DataFrame, fields: list[str], batch_time: Column) -> DataFrame:
    """Each event's fields as an envelope stamped with the batch's date and time."""
    return events.select(
        utc_date(batch_time).alias("batch_date"),
        utc_iso(batch_time).alias("batch_timestamp"),
        F.lit(1).cast("bigint").alias("total_events"),
        F.array(F.struct(*fields)).alias("events"),
    )


def snapshot_envelopes(ads: DataFrame, stamp: list[str]) -> DataFrame:
    """Each ad as an envelope.

    `stamp` names the columns that belong to the envelope, such as extraction_date;
    all others are fields of the ad.
    """
    fields = [c for c in ads.columns if c not in stamp]
    return ads.select(
        *stamp,
        F.lit(1).cast("bigint").alias("total_ads"),
        F.array(F.struct(*fields)).alias("ads"),
    )


def raw_snapshot_lines(ads: DataFrame) -> DataFrame:
    """Each ad of `operators.extraction.raw_ads` as the text of an envelope.

    `total_ads` is the number of ads of the whole snapshot, so that a snapshot some of
    whose lines are lost can be told, see `operators.quality.miscounted_snapshots`.
    """
    line = F.format_string(
        '{"extraction_date":"%s","extraction_timestamp":"%s","total_ads":%d,"ads":[%s]}',
        "extraction_date", "extraction_timestamp", "total_ads", "ad",
    )
    return ads.select(line.alias("value"))


def backcast_envelopes(ads: DataFrame) -> DataFrame:
    """Back-cast ads (with their day in fecha) as envelopes marked as synthetic."""
    midnight = F.concat(F.date_format("fecha", "yyyy-MM-dd"), F.lit("T00:00:00+00:00"))
    stamped = ads.withColumns(
        {
            "extraction_date": F.date_format("fecha", "yyyy-MM-dd"),
            "extraction_timestamp": midnight,
            "is_synthetic": F.lit(True),
        }
    ).drop("fecha")
    return snapshot_envelopes(
        stamped, ["extraction_date", "extraction_timestamp", "is_synthetic"]
    )


def write_envelopes(envelopes: DataFrame, folder: str) -> None:
    """Land a batch in its folder, once: a folder that was written whole stays as it is.

    Rewriting it would give its files new names, and readers that go by name would
    count the batch twice. What a failed attempt has left there is replaced.
    """
    if not _landed(envelopes, folder):
        envelopes.write.mode("overwrite").json(folder)


def write_lines(lines: DataFrame, folder: str) -> None:
    """The same for envelopes that are texts already."""
    if not _landed(lines, folder):
        lines.write.mode("overwrite").text(folder)


def _landed(envelopes: DataFrame, folder: str) -> bool:
    context = envelopes.sparkSession.sparkContext
    mark = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(context._jsc.hadoopConfiguration()).exists(mark)

