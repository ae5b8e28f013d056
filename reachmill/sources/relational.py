"""Spend, mapping and product tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from reachmill.contracts import SQL_MAPPING, SQL_PRODUCTS, SQL_SPEND


@dataclass(frozen=True)
class Database:
    """Where the tables are. `properties` holds user, password, driver and the like."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str, split: "Split | None" = None) -> dict[str, str]:
        options = {
            "url": self.url,
            "dbtable": table,
            "fetchsize": str(self.fetch_size),
            **self.properties,
        }
        return options | split.options() if split else options


@dataclass(frozen=True)
class Split:
    """Parallel read of one table in ranges of a numeric or date column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_table(
    spark: SparkSession, database: Database, table: str, split: Split | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**database.options(table, split)).load()


def spend_split(spark: SparkSession, database: Database, partitions: int) -> Split | None:
    """Ranges of the identity column of the spend table, None if the table is empty."""
    query = f"(select min(id) as lo, max(id) as hi from {SQL_SPEND}) bounds"
    bounds = read_table(spark, database, query).first()
    if bounds["lo"] is None:
        return None
    return Split("id", bounds["lo"], bounds["hi"], partitions)


def campaign_tables(
    spark: SparkSession, database: Database, spend_partitions: int = 16
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spend, mapping, products. Spend grows daily and is read in parallel ranges."""
    split = spend_split(spark, database, spend_partitions)
    return (
        read_table(spark, database, SQL_SPEND, split),
        read_table(spark, database, SQL_MAPPING),
        read_table(spark, database, SQL_PRODUCTS),
    )
