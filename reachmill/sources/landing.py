"""Landing files as envelopes. Which of them are new is told by `sources.ledger`.

Two file layouts live side by side in a landing folder:

* documents: indented JSON in UTF-8, whatever the file's name, compressed or not: an
  object, a list of objects, or several of these one after the other. Reading new files,
  a large document is the work of several tasks.
* lines: one compact envelope per line in part files, which is how this package
  writes. These files are splittable.

Every file below the folder is one or the other, but for hidden ones. Every record of a
file is a row with its `file_path`; `_corrupt_record` has the text of one that does not
fit the schema.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.functions.records import records
from reachmill.sinks.files import Files
from reachmill.sources.large import large_records

CORRUPT = "_corrupt_record"

LARGE = 64 << 20  # bytes from which a document is more than one task's work

LINES = "part-*"
# all other names: those that part from LINES at some character or end before it does
DOCUMENTS = "{[!p]*,p[!a]*,pa[!r]*,par[!t]*,part[!-]*,p,pa,par,part}"


def read_envelopes(spark: SparkSession, folder: str, dataset: str, schema: str) -> DataFrame:
    """All envelopes below the folder, at any depth."""
    return _both_layouts(lambda: spark.read, folder, schema)


def read_files(
    spark: SparkSession, files: list[tuple[str, int]], schema: str, scratch: str, large: int = LARGE
) -> DataFrame:
    """All envelopes of some files, given as path and length. Documents of more than `large`
    bytes are cut into their records, see `sources.large`, with `scratch` as a folder."""
    lines = [path for path, _ in files if path.rsplit("/", 1)[-1].startswith("part-")]
    documents = [(path, length) for path, length in files if path not in set(lines)]
    small, huge = ([path for path, length in documents if (length > large) == is_large] for is_large in (False, True))
    found = [
        _records(_texts(spark.read, [_literal(p) for p in some], "*", whole_file))
        for some, whole_file in ((small, True), (lines, False))
        if some
    ]
    if huge:
        found.append(large_records(spark, [_literal(p) for p in huge], scratch))
    if not found:
        found = [spark.createDataFrame([], "file_path string, text string, broken boolean")]
    return _parsed(reduce(DataFrame.unionByName, found), schema)


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\\[\]{}*?^])", r"\\\1", path)


def _both_layouts(reader, folder: str, schema: str) -> DataFrame:
    documents = _texts(reader(), folder, DOCUMENTS, whole_file=True)
    lines = _texts(reader(), folder, LINES, whole_file=False)
    return parse_envelopes(documents.unionByName(lines), schema)


def _texts(reader, folder: str | list[str], names: str, whole_file: bool) -> DataFrame:
    texts = (
        reader.format("text")
        .option("wholetext", whole_file)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .load(folder)
        .select(F.col("_metadata.file_path").alias("file_path"), "value")
    )
    if whole_file:
        return texts.withColumn("value", F.regexp_replace("value", "^\ufeff", ""))
    return texts.where(F.trim("value") != "")


def parse_envelopes(texts: DataFrame, schema: str) -> DataFrame:
    """Envelopes from rows that hold JSON texts (columns file_path, value).

    One row per record. What cannot be read in full, or has a field of another type,
    has its text in `_corrupt_record`; its other columns are not to be relied on.
    """
    return _parsed(_records(texts), schema)


def _records(texts: DataFrame) -> DataFrame:
    return texts.select("file_path", F.inline(records(F.col("value"))))


def _parsed(rows: DataFrame, schema: str) -> DataFrame:
    parsed = F.from_json("text", f"{schema}, {CORRUPT} string",
                         {"columnNameOfCorruptRecord": CORRUPT})
    fields = rows.select("file_path", "text", "broken", parsed.alias("parsed")).select(
        "file_path", "text", "broken", "parsed.*"
    )
    unread = F.when(F.col("broken"), F.col("text")).otherwise(F.col(CORRUPT))
    return fields.withColumn(CORRUPT, unread).drop("text", "broken")


def newest_snapshot(spark: SparkSession, folder: str, dataset: str) -> str | None:
    """Path of the dataset's landing entry that comes last in name order, None if none.

    An entry is a document or a folder of part files, named after the dataset. The tree is
    descended from its end: as many folders are listed as there are levels, plus those
    that turn out to have no entry.
    """
    files = Files(spark)

    def last(path: str) -> str | None:
        # a folder stands in the order of what is in it
        children = sorted((name + "/" * is_folder, name) for name, is_folder in files.children(path))
        for shown, name in reversed(children):
            if name.startswith((".", "_")):
                continue
            is_folder, is_entry = shown.endswith("/"), name.startswith(f"{dataset}_")
            if is_entry and (not is_folder or files.matching(f"{path}/{name}/{LINES}")):
                return f"{path}/{name}"
            found = last(f"{path}/{name}") if is_folder and not is_entry else None
            if found is not None:
                return found
        return None

    return last(folder.rstrip("/"))


def read_entry(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The envelopes of one landing entry."""
    document = "." in path.rsplit("/", 1)[-1]
    names = "*" if document else LINES
    return parse_envelopes(_texts(spark.read, path, names, whole_file=document), schema)
