"""Tables written beside the lake's and put in their places together.

A run writes all its tables into a staging folder first; the lake's tables stay as they
are and can be read meanwhile, also by the run itself. Then one small file, the commit
record, is put into the folder: from then on the run has happened. What follows are
renames only: of whole tables, or of the day folders of a range, of which those that have
no rows any more are removed. A run that ends before the commit record leaves nothing
behind but a staging folder that the next run deletes; one that ends after it is completed
by the next run, which does every rename that has not been done yet.

One run at a time may write a set of tables. Delta tables have a log of their own: there
the staged rows are written with overwrite or replaceWhere, which can be repeated as well.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reachmill.contracts import DATE_PARTS
from reachmill.functions.dates import in_days
from reachmill.sinks.files import Files

COMMITTED, REMOVED = "_committed", "_removed"


@dataclass(frozen=True)
class Target:
    """Where staged rows go. Without days the whole table is replaced, else the days from
    start to end (ISO text, None for an open end) and those of `also`; or, with present_only,
    those that have rows."""

    path: str
    partitions: list[str]
    table_format: str = "parquet"
    by_days: bool = False
    start: str | None = None
    end: str | None = None
    also: list[str] = field(default_factory=list)
    present_only: bool = False


def day_of(folder: str) -> date | None:
    """The day of a partition folder, laid out by fecha or by year, month and day."""
    parts = dict(part.split("=", 1) for part in folder.split("/") if "=" in part)
    try:
        if "fecha" in parts:
            return date.fromisoformat(parts["fecha"])
        return date(*(int(parts[p]) for p in DATE_PARTS))
    except (KeyError, ValueError):
        return None


class Staging:
    """The staging folder of one kind of run. Entering it completes or clears away what an
    earlier run has left."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.files = spark, folder, Files(spark)
        self.targets: list[Target] = []
        self.recover()

    def recover(self) -> None:
        if self.files.exists(f"{self.folder}/{COMMITTED}"):
            self.targets = [Target(**t) for t in json.loads(self.files.read(f"{self.folder}/{COMMITTED}"))]
            self._put_in_place()
        elif self.files.exists(self.folder):
            self.files.delete(self.folder)
        self.targets = []

    def add(self, df: DataFrame, target: Target) -> int:
        """Stage the rows for a target; returns their number, counted by the write itself."""
        counter = Observation()
        counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").partitionBy(*target.partitions).parquet(self._rows(len(self.targets)))
        self.targets.append(target)
        return counter.get["rows"]

    def read(self, number: int, schema: StructType) -> DataFrame:
        """The staged rows of a target, by the order of add."""
        return self.spark.read.schema(schema).parquet(self._rows(number))

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """A step of the run, written and read back; it goes with the staging folder."""
        path = f"{self.folder}/kept/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> None:
        self.files.write(f"{self.folder}/{COMMITTED}", json.dumps([asdict(t) for t in self.targets]))
        self._put_in_place()

    def _rows(self, number: int) -> str:
        return f"{self.folder}/{number}/rows"

    def _put_in_place(self) -> None:
        for number, target in enumerate(self.targets):
            if target.table_format != "parquet":
                self._rewrite(number, target)
            elif target.by_days:
                self._replace_days(number, target)
            else:
                self._swap(number, target)
        self.files.delete(self.folder)

    def _swap(self, number: int, target: Target) -> None:
        rows = self._rows(number)
        if not self.files.exists(rows):
            return
        if self.files.exists(target.path):
            self.files.move(target.path, f"{self.folder}/{number}/before")
        self.files.move(rows, target.path)

    def _replace_days(self, number: int, target: Target) -> None:
        rows, done = self._rows(number), f"{self.folder}/{number}/{REMOVED}"
        if not self.files.exists(done):
            if not target.present_only:
                present = set(self._day_folders(rows, target))
                for day in self._day_folders(target.path, target):
                    if day not in present and _inside(day_of(day), target):
                        self.files.delete(f"{target.path}/{day}")
            self.files.write(done, "")
        for day in self._day_folders(rows, target):
            self.files.delete(f"{target.path}/{day}")
            self.files.move(f"{rows}/{day}", f"{target.path}/{day}")

    def _day_folders(self, path: str, target: Target) -> list[str]:
        """The partition folders of a table, relative to it."""
        found = [""]
        for _ in target.partitions:
            found = [f"{f}/{name}" if f else name for f in found for name in self.files.folders(f"{path}/{f}") if "=" in name]
        return found

    def _rewrite(self, number: int, target: Target) -> None:
        rows = self.spark.read.parquet(self._rows(number))
        writer = rows.write.format(target.table_format).mode("overwrite").partitionBy(*target.partitions)
        if target.present_only:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        elif target.by_days:
            writer = writer.option("replaceWhere", delta_condition(target))
        else:
            writer = writer.option("overwriteSchema", "true")
        writer.save(target.path)


def _inside(day: date | None, target: Target) -> bool:
    if day is None:
        return False
    text = day.isoformat()
    in_range = (target.start is None or target.start <= text) and (target.end is None or text <= target.end)
    return in_range or text in target.also


def delta_condition(target: Target) -> str:
    """The range as a condition on the stored day."""
    bounds = [f"fecha >= date '{target.start}'"] if target.start else []
    bounds += [f"fecha <= date '{target.end}'"] if target.end else []
    condition = " and ".join(bounds) or "fecha is not null"
    listed = ", ".join(f"date '{day}'" for day in target.also)
    return f"({condition}) or fecha in ({listed})" if listed else condition


def outside(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Rows of the other days, undated ones among them."""
    return df.where(~F.coalesce(in_days(start, end) & F.col("fecha").isNotNull(), F.lit(False)))
