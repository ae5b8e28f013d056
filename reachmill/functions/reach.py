"""Scaling of reach figures to an earlier point in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_total(reach: Column, factor: Column) -> Column:
    """Total reach times factor, cut to a whole number, at least 1; missing counts as 0."""
    return F.greatest(F.lit(1), (F.coalesce(reach, F.lit(0)) * factor).cast("bigint"))


def scaled_count(count: Column, factor: Column) -> Column:
    """One demographic count times factor, at least 0; a missing count stays missing."""
    # greatest() skips nulls, so without the guard a missing count would become 0
    return F.when(count.isNotNull(), F.greatest(F.lit(0), (count * factor).cast("bigint")))


def scaled_breakdown(breakdown: Column, factor: Column) -> Column:
    """The whole country / age / gender tree with every count scaled."""

    def age_row(age: Column) -> Column:
        return F.struct(
            age["age_range"].alias("age_range"),
            *(scaled_count(age[g], factor).alias(g) for g in ("female", "male", "unknown")),
        )

    def country_row(country: Column) -> Column:
        return F.struct(
            country["country"].alias("country"),
            F.transform(country["age_gender_breakdowns"], age_row).alias(
                "age_gender_breakdowns"
            ),
        )

    return F.transform(breakdown, country_row)
