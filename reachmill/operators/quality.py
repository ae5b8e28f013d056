"""Checks of the rules stored data has to keep. Each returns the offending rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent table does not have."""
    return child.join(parent.select(key), key, "left_anti").select(*child.columns)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of nulls per column, all columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column_name", "null_rows")


def event_violations(
    events: DataFrame,
    required: Iterable[str],
    quantities: Iterable[int],
    channels: Iterable[str],
) -> DataFrame:
    """One row per event and broken rule, all rules in one pass.

    Rules: every required field is present, quantity and channel are among the
    allowed ones, the total is unit price times quantity rounded to cents.
    """
    required = list(required)
    expected = F.round(F.col("unit_price") * F.col("quantity"), 2)
    rules = {f"missing {name}": F.col(name).isNull() for name in required}
    checks = {
        "quantity": (F.col("quantity").isin(*quantities), ["quantity"]),
        "channel": (F.col("channel").isin(*channels), ["channel"]),
        "total_amount": (F.col("total_amount") == expected, ["total_amount", "unit_price", "quantity"]),
    }
    for name, (holds, fields) in checks.items():
        # what nulls leave undecided breaks the rule, unless the null is reported as missing
        missing = [F.col(f).isNull() for f in fields if f in required]
        rules[name] = ~F.coalesce(holds, reduce(or_, missing, F.lit(False)))
    broken = F.array_compact(F.array(*(_name_if(bad, name) for name, bad in rules.items())))
    return events.select("event_id", F.explode(broken).alias("rule"))


def miscounted_envelopes(envelopes: DataFrame, declared: str, body: str) -> DataFrame:
    """Envelopes whose declared count is not the length of their array."""
    actual = F.coalesce(F.array_size(body), F.lit(0)).cast("bigint")
    return envelopes.withColumn("actual", actual).where(
        ~F.col(declared).eqNullSafe(F.col("actual"))
    )


def miscounted_snapshots(
    envelopes: DataFrame, key: str = "extraction_timestamp", declared: str = "total_ads", body: str = "ads"
) -> DataFrame:
    """Snapshots whose declared number of ads is not that of all their envelopes together."""
    length = F.coalesce(F.array_size(body), F.lit(0)).cast("bigint")
    found = envelopes.groupBy(key).agg(F.max(declared).alias(declared), F.sum(length).alias("actual"))
    return found.where(~F.col(declared).eqNullSafe(F.col("actual")))


def _name_if(condition: Column, name: str) -> Column:
    return F.when(condition, F.lit(name))
