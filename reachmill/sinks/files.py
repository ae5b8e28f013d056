"""The few file operations that Spark's readers and writers do not offer, on any Hadoop store."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession) -> None:
        self._context = spark.sparkContext

    def _at(self, path: str):
        found = self._context._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self._context._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        found, store = self._at(path)
        return store.exists(found)

    def delete(self, path: str) -> None:
        found, store = self._at(path)
        store.delete(found, True)

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder to a path that does not exist yet."""
        found, store = self._at(source)
        to, _ = self._at(target)
        store.mkdirs(to.getParent())
        if not store.rename(found, to):
            raise OSError(f"{source} could not be moved to {target}")

    def matching(self, pattern: str) -> list[str]:
        """Paths that fit a pattern, in name order."""
        found, store = self._at(pattern)
        return sorted(status.getPath().toString() for status in store.globStatus(found) or [])

    def children(self, path: str) -> list[tuple[str, bool]]:
        """Names of everything in a folder, and whether each is a folder."""
        found, store = self._at(path)
        if not store.exists(found):
            return []
        return [(s.getPath().getName(), s.isDirectory()) for s in store.listStatus(found)]

    def folders(self, path: str) -> list[str]:
        return sorted(name for name, is_folder in self.children(path) if is_folder)

    def names(self, path: str) -> list[str]:
        return sorted(name for name, _ in self.children(path))

    def stands_at(self, path: str, length: int, modified: int) -> bool:
        """Whether the file is there with this length and time (milliseconds)."""
        found, store = self._at(path)
        if not store.exists(found):
            return False
        status = store.getFileStatus(found)
        return status.getLen() == length and status.getModificationTime() == modified

    def write(self, path: str, text: str) -> None:
        """A small file, there as a whole or not at all."""
        beside = f"{path}.tmp"
        found, store = self._at(beside)
        stream = store.create(found, True)
        pieces = [text[k : k + 10_000] for k in range(0, len(text), 10_000)]
        stream.writeInt(len(pieces))
        for piece in pieces:
            stream.writeUTF(piece)
        stream.close()
        self.move(beside, path)

    def read(self, path: str) -> str:
        found, store = self._at(path)
        stream = store.open(found)
        text = "".join([stream.readUTF() for _ in range(stream.readInt())])
        stream.close()
        return text
