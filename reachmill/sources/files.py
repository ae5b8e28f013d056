"""Stored tables, the product catalogue and API page dumps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.contracts import ADS_PAGE, CATALOGUE
from reachmill.functions.dates import between_days
from reachmill.functions.records import records
from reachmill.sources.landing import CORRUPT


def read_stored(
    spark: SparkSession,
    path: str,
    table_format: str = "parquet",
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """A stored table, all of it or an inclusive range of days.

    The range prunes folders, so it needs a table with date partition columns.
    """
    table = spark.read.format(table_format).load(path)
    if start is None and end is None:
        return table
    return table.where(between_days(start, end))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Products of catalogue files, in the shape of the relational product table."""
    files = spark.read.text(path, wholetext=True).select(F.inline(records(F.col("value"))))
    document = files.select(F.from_json("text", CATALOGUE).alias("document"))
    return document.select(F.inline("document.products")).select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        F.col("price").cast("decimal(10,2)").alias("price"),
    )


def read_raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Dumped response pages with their ads as received, each as JSON text.

    Columns file_path, data and _corrupt_record, the text of a page that is cut off or
    has something other than a list as its data. Spark passes over files of no bytes.
    """
    files = (
        spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_path"), F.inline(records(F.col("value"))))
    )
    page = F.from_json("text", f"data array<string>, {CORRUPT} string",
                       {"columnNameOfCorruptRecord": CORRUPT})
    torn = F.when(F.col("broken") | F.col("page").isNull(), F.coalesce("text", F.lit("")))
    return files.withColumn("page", page).select(
        "file_path",
        F.array_compact("page.data").alias("data"),
        F.coalesce(torn, F.col(f"page.{CORRUPT}")).alias(CORRUPT),
    )


def read_ads_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Dumped response pages of the ads API, one row per page, however many a file holds."""
    files = spark.read.text(folder, wholetext=True).select(F.inline(records(F.col("value"))))
    return files.select(F.from_json("text", ADS_PAGE).alias("page")).select("page.*")
