"""Insert-if-absent by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def absent_rows(
    target: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """Incoming rows to insert: key not in target, first row per key in `order_by` order.

    Key columns are expected to be non-null. Known keys are taken out first, so that
    only absent rows are sorted, and adaptive execution can split a key delivered very
    often in that join.
    """
    absent = incoming.join(target.select(*keys), keys, "left_anti")
    row = F.struct(*(F.col(c) for c in incoming.columns))
    first = F.min_by(row, F.struct(*order_by)).alias("row")
    return absent.groupBy(*keys).agg(first).select("row.*")


def upserted(
    target: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """The target after the insert."""
    return target.unionByName(
        absent_rows(target, incoming.select(*target.columns), keys, order_by)
    )
