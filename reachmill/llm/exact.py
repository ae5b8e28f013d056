"""Exact deduplication against a persistent digest index. Built-in functions only.

The index is a table bucketed and sorted by digest. A batch of new data is reduced to one
row per digest; a sort-merge anti join with the index takes out the digests that it has, and
what is left is new. Both are appended: the new digests, and for known ones an increment of
their count and largest id, each under the batch's name. A text's group is the sum of its
rows, whatever the number of batches it came in. A batch repeated after a failure finds what
it has appended under its name and appends the rest.

Texts are equal when they are the same after A-Z became a-z. Defined cases: a null text
counts as empty; of equal texts the largest id stays; null ids lose against any other, and
if there is no other id the group's keep id is null and no row of it is kept by id; rows
with the same id and text share one fate; an empty batch appends nothing. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.llm.scratch import Scratch

#: The letters that fold.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def folded(text: Column) -> Column:
    """A-Z to a-z and nothing else. For text in ASCII alone lower() does just that, faster."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and 32-byte SHA-256 of the folded text."""
    return docs.select(F.col(key).alias("id"), F.unhex(F.sha2(folded(F.col(text)), 256)).alias("digest"))


def create_index(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """An empty index at path. Give as many buckets as tasks that the index shall be
    joined by: a multiple of the cluster's cores, at most some hundred MB a bucket."""
    empty = spark.createDataFrame([], "digest binary, batch string, keep_id bigint, group_size bigint, is_new boolean")
    empty.write.bucketBy(buckets, "digest").sortBy("digest").option("path", path).saveAsTable(table)


def append(scratch: Scratch, batch: DataFrame, name: str, table: str, path: str, buckets: int) -> None:
    """Bring a batch of digests into the index under its name. A batch is appended before
    the next one is begun."""
    groups = batch.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # written first: the optimizer would move the anti join below the counting, and copies
    # of one text would then all travel to one task
    groups = scratch.keep(groups.repartition(buckets, "digest"), f"groups-{name}")
    index = scratch.spark.table(table)
    mine, known = index.where(F.col("batch") == name).select("digest"), index.where(F.col("batch") != name).select("digest")
    left = groups.join(mine.hint("merge"), "digest", "left_anti")
    new = left.join(known.hint("merge"), "digest", "left_anti").withColumn("is_new", F.lit(True))
    more = left.join(known.hint("merge"), "digest", "left_semi").withColumn("is_new", F.lit(False))
    rows = new.unionByName(more).select("digest", F.lit(name).alias("batch"), "keep_id", "group_size", "is_new")
    rows.repartition(buckets, "digest").write.mode("append").bucketBy(buckets, "digest").sortBy("digest").option("path", path).saveAsTable(table)


def groups_of(index: DataFrame) -> DataFrame:
    """One row for each text: digest, keep_id, group_size. Its rows lie in one bucket."""
    return index.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def verdicts(batch: DataFrame, groups: DataFrame, large: int = 1000, most_large: int = 50_000) -> DataFrame:
    """Every row of the batch with its group (groups_of, as a written table): id, digest,
    keep_id, group_size, kept.

    Copies of one text may be a third of all rows, so rows of large groups do not meet
    their group in a shuffle. Of groups above the total / most_large rows there are fewer
    than most_large, which bounds what is broadcast to a few MB at any size of the table;
    all others are joined by sort and merge, and none of them is large."""
    total = groups.agg(F.sum("group_size").alias("rows")).first()["rows"] or 0
    is_large = F.col("group_size") > max(large, total // most_large)
    hot = F.broadcast(groups.where(is_large))
    joined = batch.join(hot, "digest").unionByName(batch.join(hot, "digest", "left_anti").join(groups.where(~is_large), "digest"))
    kept = F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False))
    return joined.select("id", "digest", "keep_id", "group_size", kept.alias("kept"))


def index_name(path: str) -> str:
    """A catalogue name for the index at a path; the same path has the same name."""
    import zlib

    return f"digest_index_{zlib.crc32(path.encode()):08x}"
