"""Continuous capture: Kafka messages to landing envelopes."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reachmill.contracts import LANDING, SALE_EVENT, SALE_FIELDS, SALES, SALES_ENVELOPE
from reachmill.functions.dates import dated_folder, utc_date
from reachmill.functions.records import records
from reachmill.sinks.landing import sales_envelopes, write_envelopes
from reachmill.sources.landing import CORRUPT

TRIGGER = "1 minute"  # fixed value: how often a batch is landed
EVENT_FIELDS = list(SALE_FIELDS)


def parse_messages(messages: DataFrame) -> DataFrame:
    """One row per sale event: its fields, enqueued_time and the raw text.

    A message holds bare events, envelopes of events, or both; one parse with the
    fields of both serves either. A record that is neither, has a field of another
    type, or is an envelope without events gives one row whose event fields are all
    null.
    """
    text = F.col("value").cast("string")
    schema = f"{SALES_ENVELOPE}, {SALE_EVENT}, {CORRUPT} string"
    body = F.from_json("text", schema, {"columnNameOfCorruptRecord": CORRUPT})
    read = ~F.col("broken") & F.col("body").isNotNull() & F.col(f"body.{CORRUPT}").isNull()
    bare = F.array(F.struct(*(F.col(f"body.{f}").alias(f) for f in EVENT_FIELDS)))
    several = F.when(F.size("body.events") > 0, F.col("body.events"))
    nothing = F.array(F.struct(*(F.lit(None).cast(t).alias(f) for f, t in SALE_FIELDS.items())))
    events = F.when(
        read, F.coalesce(several, F.when(F.col("body.events").isNull(), bare), nothing)
    ).otherwise(nothing)
    return (
        messages.select(F.col("timestamp").alias("enqueued_time"), F.inline_outer(records(text)))
        .select(
            F.col("text").alias("raw"),
            "enqueued_time",
            F.coalesce("broken", F.lit(True)).alias("broken"),
            body.alias("body"),
        )
        .select("raw", "enqueued_time", F.inline(events))
        .select(*EVENT_FIELDS, "enqueued_time", "raw")
    )


def is_readable():
    """Whether a parsed row has at least one event field."""
    return F.coalesce(*(F.col(f).cast("string") for f in EVENT_FIELDS)).isNotNull()


def batch_writer(
    lake: str, dataset: str = SALES, stream: Callable[[], str] = lambda: "manual"
) -> Callable[[DataFrame, int], None]:
    """The function to call for each micro-batch.

    A landed unit is named after the stream's own id and the batch's, and written once:
    the mark that Spark leaves in a folder written whole is its commit record. The batch
    time is the one Spark recorded for the batch. So a batch that is run again changes
    nothing, while the batches of another stream, or of one whose checkpoint was reset and
    whose ids begin anew, are units of their own. Unreadable messages are set aside as
    raw text under `quarantine`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        unit = f"stream-{stream()}-batch-{batch_id:012d}"
        batch.persist()
        try:
            found = batch.agg(
                F.min(utc_date(F.col("batch_time"))).alias("day"),
                F.count_if(is_readable()).alias("events"),
                F.count_if(~is_readable()).alias("rejected"),
            ).first()
            if found["events"]:
                day = dated_folder(LANDING, dataset, date.fromisoformat(found["day"]))
                events = batch.where(is_readable())
                write_envelopes(
                    sales_envelopes(events, [*EVENT_FIELDS, "enqueued_time"], F.col("batch_time")),
                    f"{lake}/{day}/{unit}",
                )
            if found["rejected"]:
                rejected = batch.where(~is_readable()).select("raw", "enqueued_time")
                write_envelopes(rejected, f"{lake}/quarantine/{dataset}/{unit}")
        finally:
            batch.unpersist()

    return write


def start_capture(
    messages: DataFrame,
    lake: str,
    dataset: str = SALES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start landing a message stream (columns value and timestamp) without end.

    The size of a batch is bounded by the source, see max_offsets_per_trigger.
    Pass trigger={"availableNow": True} to take what is there and stop.
    """
    stamped = parse_messages(messages).withColumn("batch_time", F.current_timestamp())
    # the id is the checkpoint's: it lasts over restarts, and a new checkpoint has another one
    identity: Future[str] = Future()
    query = (
        stamped.writeStream.foreachBatch(batch_writer(lake, dataset, identity.result))
        .option("checkpointLocation", f"{lake}/checkpoints/{dataset}_streaming")
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
    identity.set_result(query.id)
    return query
