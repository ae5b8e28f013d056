"""Landing to bronze as a finite, incremental job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reachmill.contracts import BRONZE, DATE_PARTS, LANDING
from reachmill.functions.dates import with_date_parts
from reachmill.plans.bronze import readable, unreadable
from reachmill.sinks.files import Files
from reachmill.sources.landing import CORRUPT, LARGE, read_files
from reachmill.sources.ledger import FILES_PER_BATCH, Batch, Ledger


@dataclass
class Ingested:
    """What a run has done."""

    batches: int = 0
    files: int = 0
    rows: int = 0
    set_aside: int = 0


def ingest(
    spark: SparkSession,
    lake: str,
    dataset: str,
    schema: str,
    body: str,
    flatten: Callable[[DataFrame], DataFrame],
    table_format: str = "parquet",
    max_files: int = FILES_PER_BATCH,
    archive: bool = False,
    large: int = LARGE,
) -> Ingested:
    """Bring landing files not read before into bronze, and what cannot be read to `quarantine`.

    Stops once everything that was there has been read. Running it again adds nothing.
    Each file is read and parsed once: the batch is written as envelopes, which both
    outputs are then taken from. Both are appended under the batch's number and the
    batch is closed after that, so a run that fails in between is repeated: the next one
    finds the envelopes, clears away what it has under that number, and writes it anew.
    With `archive` read files are moved to `archive/<dataset>`. Documents of more than
    `large` bytes are read by several tasks.
    """
    folder = f"{lake}/checkpoints/{dataset}_{BRONZE}"
    ledger, done = Ledger(spark, folder, f"{lake}/{LANDING}/{dataset}"), Ingested()
    if archive:
        ledger.archive(f"{lake}/archive/{dataset}")
    for batch in ledger.batches(max_files):
        envelopes = _envelopes(spark, batch, schema, f"{folder}/envelopes", large)
        rows = with_date_parts(flatten(envelopes.where(readable())))
        aside = unreadable(envelopes, body)
        done.rows += _append(rows, f"{lake}/{BRONZE}/{dataset}", batch, table_format, DATE_PARTS)
        done.set_aside += _append(aside, f"{lake}/quarantine/{dataset}_files", batch, table_format)
        ledger.close(batch)
        Files(spark).delete(f"{folder}/envelopes")
        done.batches, done.files = done.batches + 1, done.files + len(batch.files)
        if archive:
            ledger.archive(f"{lake}/archive/{dataset}")
    return done


def _envelopes(spark: SparkSession, batch: Batch, schema: str, folder: str, large: int) -> DataFrame:
    """The batch's envelopes, as a table that an earlier run may have written already."""
    path = f"{folder}/{batch.number:012d}"
    if not (batch.again and Files(spark).exists(f"{path}/_SUCCESS")):
        files = [(path, length) for path, length, _ in batch.files]
        read_files(spark, files, schema, f"{folder}/pieces", large).write.mode("overwrite").parquet(path)
    return spark.read.schema(f"file_path string, {schema}, {CORRUPT} string").parquet(path)


def _append(
    df: DataFrame, path: str, batch: Batch, table_format: str, partitions: tuple[str, ...] = ()
) -> int:
    """Append rows under the number of a batch, once; returns their number."""
    name = f"batch-{batch.number:012d}"
    files = Files(df.sparkSession)
    writer = lambda rows: rows.write.format(table_format).mode("append").partitionBy(*partitions)
    if table_format == "delta":
        # Delta's log has the number of the last append of each application
        writer_of = lambda rows: writer(rows).option("txnAppId", path).option("txnVersion", batch.number)
    else:
        writer_of = lambda rows: writer(rows).option("mapreduce.output.basename", name)
        if batch.again:
            for left in files.matching(path + "/*" * len(partitions) + f"/{name}-*"):
                files.delete(left)
    if not partitions and df.isEmpty():  # else a file without rows would be left each time
        return 0
    counter = Observation()
    writer_of(df.observe(counter, F.count(F.lit(1)).alias("rows"))).save(path)
    return counter.get["rows"]
