"""Documents too large for one task, cut into their records wherever they are split.

A document is read as the pieces between its closing braces, by byte ranges like any text.
Whether a brace stands in a string, and how deep it closes, depends on all pieces before it;
both are running sums: quotes modulo two, then braces outside strings, then records. Each is
taken inside a byte range first, all ranges at once, and the ranges of a file, a few rows,
are added up after that. The pieces of a record then meet by file and record number, so
what one task holds at once is a record.

Records are those of `functions.records` for every document that is well formed. Of one
that is not, the records that are complete are read; what stands between them, or is cut
off at its end, is a broken record with its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE = ["file_path", "block"]


def large_records(spark: SparkSession, paths: list[str], scratch: str) -> DataFrame:
    """file_path, text and broken of every record of some documents. `scratch` is a folder for
    the pieces, which are written once."""
    _pieces(spark, paths).write.mode("overwrite").parquet(scratch)
    pieces = spark.read.parquet(scratch)
    numbers = pieces.drop("value")
    quoted = _running(numbers, F.col("quotes"), "quotes_before")
    inside = F.col("quotes_before") % 2 == 1
    still_inside = (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    opened = F.when(inside, F.col("opened_in_string")).otherwise(F.col("opened"))
    closed = (F.col("is_closed") & ~still_inside).cast("int")
    deep = _running(quoted.withColumns({"opened": opened, "closed": closed}), F.col("opened") - F.col("closed"), "depth")
    ends = (F.col("closed") == 1) & (F.col("depth") + F.col("opened") == 1)
    counted = _running(deep.withColumn("ends", ends.cast("int")), F.col("ends"), "record")

    whole = pieces.drop("quotes", "opened", "opened_in_string").join(counted.select(*RANGE, "place", "ends", "record"), [*RANGE, "place"])
    piece = F.struct("block", "place", F.concat("value", F.when(F.col("is_closed"), "}").otherwise("")).alias("value"))
    records = whole.groupBy("file_path", "record").agg(F.sort_array(F.collect_list(piece)).alias("parts"), F.max("ends").alias("ends"))
    text = F.regexp_replace(F.array_join("parts.value", ""), r"^[\s,\[\]]++", "")
    found = records.select("file_path", text.alias("text"), "ends").where("text <> ''")
    return found.select("file_path", "text", (~F.col("text").startswith("{") | (F.col("ends") == 0)).alias("broken"))


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The text before each closing brace, and after the last, with its numbers."""
    read = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    # a file that does not end with a brace has a last piece without one; three bytes of a
    # byte order mark may have been passed over
    sizes = read.groupBy("file_path").agg(
        (F.sum(F.octet_length("value") + 1) - F.first("size")).isin(1, -2).alias("is_open"), F.max(F.struct("block", "place")).alias("last")
    )
    known = read.join(sizes, "file_path").withColumn(
        "is_closed", ~(F.col("is_open") & (F.struct("block", "place") == F.col("last")))
    )
    plain = F.regexp_replace(F.col("value"), r"(?s)\\.", "")
    first = F.when(F.col("block") == 0, F.regexp_replace("value", "^\\ufeff", "")).otherwise(F.col("value"))
    return known.select(
        *RANGE,
        "place",
        first.alias("value"),
        "is_closed",
        _count(plain, '"').alias("quotes"),
        _count(_outside_strings(plain), "{").alias("opened"),
        _count(_outside_strings(F.concat(F.lit('"'), plain)), "{").alias("opened_in_string"),
    )


def _outside_strings(text: Column) -> Column:
    return F.regexp_replace(text, r'"[^"]*+(?:"|$)', "")


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _running(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """The sum of a value over all pieces of the file before this one."""
    valued = pieces.withColumn("_value", value)
    before = Window.partitionBy(*RANGE).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = valued.groupBy(*RANGE).agg(F.sum("_value").alias("_sum"))
    ranges = ranges.select(*RANGE, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    inside = valued.withColumn(name, F.coalesce(F.sum("_value").over(before), F.lit(0)))
    return inside.join(ranges, RANGE).withColumn(name, F.col(name) + F.col("_earlier")).drop("_value", "_earlier")
