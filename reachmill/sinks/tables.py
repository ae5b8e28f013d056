"""Writers for silver and gold tables.

Each writer runs its plan once. Row counts come from the write itself, through
`observe`, not from a second run. A table is replaced by a rename after its rows are
written, so a job that is killed leaves a table that can be read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reachmill.contracts import DATE_PARTS
from reachmill.functions.dates import with_date_parts
from reachmill.operators.upsert import absent_rows
from reachmill.sinks.staged import Staging, Target


def write_silver(
    df: DataFrame,
    path: str,
    table_format: str = "parquet",
    rebalance: bool = True,
    only_days_present: bool = False,
) -> int:
    """Overwrite a table laid out by day; returns the number of rows written.

    The table is written beside and then put in place, see `sinks.staged`.
    `only_days_present` replaces just the days found in `df` and leaves the others.
    """
    staging = Staging(df.sparkSession, beside(path))
    target = silver_target(path, table_format)
    if only_days_present:
        target = replace(target, by_days=True, present_only=True)
    written = staging.add(laid_out_by_day(df, rebalance), target)
    staging.commit()
    return written


def laid_out_by_day(df: DataFrame, rebalance: bool = True) -> DataFrame:
    """df with the date partition columns.

    `rebalance` gathers each day into files of a sensible size, splitting large
    days, and is meant for the output of joins and aggregates, whose tasks all hold
    some rows of every day. A table whose tasks already follow the days, like one
    derived row by row from bronze, is better written as it comes.
    """
    table = with_date_parts(df)
    return table.hint("rebalance", *DATE_PARTS) if rebalance else table


def silver_target(path: str, table_format: str = "parquet", days: tuple | None = None) -> Target:
    """A silver table's place: whole, or the days of a range (first, last; None is open)."""
    return _by_range(Target(path, list(DATE_PARTS), table_format), days)


def gold_target(
    path: str, table_format: str = "parquet", by_day: bool = False, days: tuple | None = None, also: Iterable[date] = ()
) -> Target:
    """A gold table's place; `by_day` lays it out in one folder per day, which makes `fecha`
    its last column. `also` are single days outside the range."""
    target = _by_range(Target(path, ["fecha"] if by_day else [], table_format), days)
    return replace(target, also=sorted(d.isoformat() for d in also))


def _by_range(target: Target, days: tuple | None) -> Target:
    if days is None:
        return target
    start, end = (None if d is None else d.isoformat() for d in days)
    return replace(target, by_days=True, start=start, end=end)


def write_gold(
    df: DataFrame,
    path: str,
    table: str | None = None,
    table_format: str = "parquet",
    by_day: bool = False,
    only_days_present: bool = False,
) -> int:
    """Overwrite a gold table and its schema; returns the number of rows written.

    The table is written beside and then put in place, see `sinks.staged`.
    `only_days_present` replaces just the days found in `df`. With `table`
    ("schema.table" or "catalog.schema.table") the data at `path` is also registered in
    the catalog; the schema is created if needed.
    """
    staging = Staging(df.sparkSession, beside(path))
    target = gold_target(path, table_format, by_day)
    if only_days_present:
        target = replace(target, by_days=True, present_only=True)
    written = staging.add(df.hint("rebalance", "fecha") if by_day else df, target)
    staging.commit()
    if table is not None:
        register(df.sparkSession, table, path, table_format)
    return written


def beside(path: str) -> str:
    """The staging folder of a table, hidden from readers of the folder around it."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/.{name}-next"


def register(spark: SparkSession, table: str, path: str, table_format: str = "parquet") -> None:
    """Make the catalog show the table at `path` as it is now, with its columns and days."""
    create_schema(spark, table)
    stored = spark.read.format(table_format).load(path)
    if spark.catalog.tableExists(table):
        if table_format == "delta":
            return
        if spark.table(table).schema != stored.schema:
            spark.sql(f"drop table {_quoted(table)}")
    if not spark.catalog.tableExists(table):
        spark.sql(f"create table {_quoted(table)} using {table_format} location '{path}'")
    if table_format != "delta":
        if any(part in stored.columns for part in _partitions(spark, table)):
            spark.sql(f"msck repair table {_quoted(table)} sync partitions")
        spark.catalog.refreshTable(table)


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def create_schema(spark: SparkSession, table: str) -> None:
    schema = table.rsplit(".", 1)[0]
    spark.sql(f"create schema if not exists {_quoted(schema)}")


def append_absent(target: DataFrame, incoming: DataFrame, keys: list[str], path: str,
                  order_by: list[str], table_format: str = "parquet") -> int:
    """Append to the table at `path` the incoming rows whose key it does not have yet."""
    counter = Observation()
    new = absent_rows(target, incoming, keys, order_by)
    new.observe(counter, F.count(F.lit(1)).alias("rows")).write.format(table_format).mode(
        "append"
    ).save(path)
    return counter.get["rows"]


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))
