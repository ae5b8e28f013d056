"""Which landing files have been read.

The ledger is a table of path, length and modification time, a folder of rows for each
batch. What the listing has and the ledger has not is new, whatever its age; a file that
was replaced since is new again. A batch is opened by writing its files into the ledger
and closed by a mark; one that was opened and not closed is read again, with just the same files.

Read files may be archived: moved out of landing into a folder of their own. The ledger
then forgets them, and neither it nor the listing grows with history.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.sinks.files import Files

ENTRY = "path string, length bigint, modified bigint"  # milliseconds since 1970
FILES_PER_BATCH = 100_000  # bounds a batch, and the list of paths that the driver holds
MOVERS = 16  # renames wait for the store, not for this machine


@dataclass(frozen=True)
class Batch:
    number: int
    files: list[tuple[str, int, int]]
    again: bool  # an earlier run has opened it and may have written some of it


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, landing: str) -> None:
        self.spark, self.folder, self.landing, self.files = spark, folder, landing, Files(spark)

    def listing(self) -> DataFrame:
        """Path, length and time of every landing file; no file is opened."""
        if not self.files.exists(self.landing):
            return self.spark.createDataFrame([], ENTRY)
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.landing)
        return found.select("path", "length", F.unix_millis("modificationTime").alias("modified"))

    def batches(self, most: int = FILES_PER_BATCH) -> Iterator[Batch]:
        """Batches of at most so many unread files, oldest first, until there is none. The next
        one is opened when the one before has been closed. A new batch that has room left was
        the last one; files that have come since are for the next run."""
        while (batch := self._opened() or self._open(most)) is not None:
            yield batch
            if batch.number > self._closed():
                raise RuntimeError(f"batch {batch.number} was not closed")
            if not batch.again and len(batch.files) < most:
                return

    def close(self, batch: Batch) -> None:
        before = self.files.names(f"{self.folder}/closed")
        self.files.write(f"{self.folder}/closed/{batch.number:012d}", "")
        for name in before:
            self.files.delete(f"{self.folder}/closed/{name}")

    def archive(self, to: str) -> None:
        """Move the files of closed batches from landing to the same places below a folder."""
        closed = self._closed()
        for number in self._numbers():
            if number <= closed:
                entries = self._entries(number)
                with ThreadPoolExecutor(MOVERS) as pool:
                    list(pool.map(lambda entry: self._put_away(to, *entry), entries))
                self.files.delete(self._rows(number))

    def _put_away(self, to: str, path: str, length: int, modified: int) -> None:
        # a file that was replaced after it was read stays: it is a new one
        if self.files.stands_at(path, length, modified):
            below = path.split(self._below(), 1)[1]
            target = f"{to}/{below}"
            self.files.delete(target)
            self.files.move(path, target)

    def _below(self) -> str:
        return self.landing.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"

    def _rows(self, number: int) -> str:
        return f"{self.folder}/files/batch={number:012d}"

    def _numbers(self) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in self.files.folders(f"{self.folder}/files"))

    def _closed(self) -> int:
        return max((int(name) for name in self.files.names(f"{self.folder}/closed") if name.isdigit()), default=-1)

    def _entries(self, number: int) -> list[tuple[str, int, int]]:
        rows = self.spark.read.schema(ENTRY).parquet(self._rows(number)).orderBy("modified", "path")
        return [tuple(row) for row in rows.collect()]  # at most the files of a batch

    def _opened(self) -> Batch | None:
        for number in self._numbers():
            if number > self._closed():
                if self.files.exists(f"{self._rows(number)}/_SUCCESS"):
                    return Batch(number, self._entries(number), again=True)
                self.files.delete(self._rows(number))
        return None

    def _open(self, most: int) -> Batch | None:
        known, listed = self._numbers(), self.listing()
        if known:
            read = self.spark.read.schema(ENTRY).parquet(*(self._rows(n) for n in known))
            listed = listed.join(read, ["path", "length", "modified"], "left_anti")
        files = [tuple(row) for row in listed.orderBy("modified", "path").limit(most).collect()]
        if not files:
            return None
        number = max([*known, self._closed()], default=-1) + 1
        self.spark.createDataFrame(files, ENTRY).coalesce(1).write.mode("overwrite").parquet(self._rows(number))
        return Batch(number, files, again=False)
