"""Tables written between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_NOTED: list[list[Scratch]] = []


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session may go without that
    setting: there one process reads and writes everything, so its temporary folder does."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _OWN.setdefault("path", "file://" + tempfile.mkdtemp(prefix="reachmill-llm-"))


class Scratch:
    """One run's own folder below the shared one; each table in it is written once and read back."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
        if _NOTED:
            _NOTED[-1].append(self)

    def keep(self, frame: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write the table and read it back: cuts the lineage and survives lost executors.
        Where the number of rows is known, a file holds about half a million of them, so
        that a small table is not written as one file for each of many tasks."""
        target = f"{self.path}/{name}"
        if rows is not None:
            frame = frame.coalesce(1 + rows // 500_000)
        frame.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(frame.schema).parquet(target)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads any more; * stands for any letters."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path
        for name in names:
            target = path(f"{self.path}/{name}")
            files = target.getFileSystem(context._jsc.hadoopConfiguration())
            for found in files.globStatus(target) or []:
                files.delete(found.getPath(), True)


class Released:
    """Within this block every new Scratch is noted; at its end their folders are deleted.
    For callers that have by then written what they want to keep elsewhere."""

    def __enter__(self) -> Released:
        _NOTED.append([])
        return self

    def __exit__(self, *_) -> None:
        for scratch in _NOTED.pop():
            scratch.drop("*")
