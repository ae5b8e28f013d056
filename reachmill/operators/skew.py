"""Joins that survive a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def salted_left_join(
    left: DataFrame, right: DataFrame, on: list[str], spread: list[str], buckets: int = 8
) -> DataFrame:
    """Left join in which the rows of one key are shared out over `buckets` tasks.

    The bucket of a left row is a hash of its `spread` columns; each right row is
    repeated once per bucket, so `right` should be the small, pre-aggregated side.
    The result equals a plain left join.

    Because of the extra key, both inputs reach the join straight from a shuffle,
    also when `right` is an aggregate. That is what adaptive execution needs to
    split an oversized partition further, or to turn the join into a broadcast
    once the measured size of `right` allows it.
    """
    bucket = F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    joined = left.withColumn(SALT, bucket).join(
        right.withColumn(SALT, copies), [*on, SALT], "left"
    )
    return joined.drop(SALT)
