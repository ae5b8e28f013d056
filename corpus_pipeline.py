"""A corpus made ready for training: five stages, each reading what the one before has
written. All but the last return the columns of documents.

A stage carries a row's columns as one struct beside its own, so that no name in documents
can clash with one of its own; it reads doc_id (of any type that can be sorted), text and
source, and expects no more. encode alone adds columns: piece_ids, lossless and
n_pieces, which replace those of the same names. Rows are told apart by a number, as ids may
repeat; a null text has no words, no lines and no pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.llm import lines, mixing, neardup, pieces, quality
from reachmill.llm.scratch import Released, Scratch
from reachmill.llm.shipping import ship


def _whole(docs: DataFrame) -> Column:
    """All columns of a row as one."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")


def _numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with a number and doc_id, text and the other columns, written so that they stay
    the same."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(None).cast("boolean")
    return scratch.keep(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", rest.alias("rest")), "numbered")


def _columns(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of docs out of numbered rows."""
    stored = {c: F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`") for c in docs.columns}
    return [changed.get(c, column).alias(c) for c, column in stored.items()]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes as a whole."""
    ship(spark)
    rows = docs.select("source", "text", _whole(docs))
    judged = quality.with_measures(rows).withColumn("base_failed", quality.base_failed())
    counted = Scratch(spark, "quality").keep(judged.select("source", "base_failed"), "judged")
    verdicts = quality.host_verdicts(counted, "source")
    kept = quality.with_host_verdict(judged.where(~F.col("base_failed")), verdicts, "source")
    return kept.where(~F.col("host_rejected")).select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are copies of an earlier one go; documents of which no word is left go too.
    The smallest id comes first."""
    ship(spark)
    scratch = Scratch(spark, "lines")
    rows = _numbered(docs, scratch)
    classes = lines.classes(rows, scratch, key="row", min_chars=1, order="doc_id")
    dropped = scratch.keep(classes.where(~F.col("kept")).select("doc_id", "line_no"), "dropped")
    scratch.drop("places", "all-*")
    left = lines.without(rows, dropped, key="row").where(mixing.n_words(F.col("text")) > 0)
    return left.select(*_columns(docs, n_chars=F.char_length("text").cast("long")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (runs of five words, 0.8 or more alike): the
    one with the smallest id, rows without id last."""
    ship(spark)
    scratch = Scratch(spark, "near")
    rows = _numbered(docs, scratch)
    classed = neardup.classes(rows, scratch, key="row").select(F.col("id").alias("row"), "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    named = classed.join(rows.select("row", "doc_id"), "row")
    stay = scratch.keep(named.groupBy("component_id").agg(F.min(place).alias("first")).select("first.row"), "stay")
    scratch.drop("prints", "groups", "all-*")
    return rows.join(stay, "row", "left_semi").select(*_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: documents not drawn go, others come as often as
    drawn. Rows equal in id, size and text share one fate."""
    ship(spark)
    place = mixing.place(F.array("source"), mixing.n_words(F.col("text")), F.col("doc_id"), tie=F.xxhash64("text"))
    rows = docs.select(_whole(docs), place.alias("place"))
    plan, _, _ = mixing.plan(Scratch(spark, "mix").keep(rows.select("place"), "places"))
    drawn = mixing.with_times(rows, plan).where("mix_times > 0")
    return drawn.select("doc", F.explode(F.sequence(F.lit(1), F.col("mix_times")))).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as piece ids, and whether they decode to its text."""
    ship(spark)
    own = ("text", "n_pieces", "piece_ids", "lossless")
    cut = pieces.encoded_documents(docs, pieces.model_bytes(), keep=[c for c in docs.columns if c not in own])
    return cut.withColumn("n_pieces", F.size("piece_ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: Edit distance joins, MinHash and merge-dropout are beyond SQL: the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next one reads it. What a stage has
    set down for itself is deleted when its result is written, and so is that of the stage before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        with Released():
            docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{n}")
        scratch.drop(f"stage-{n - 1}")
    return docs
