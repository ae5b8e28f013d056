"""Money: sums and return on ad spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_sum(rows: DataFrame, amount: str) -> Column:
    """Sum of an amount column of rows, rounded to cents, of the column's kind.

    Binary fractions are added up as decimals: a sum of doubles depends on the order
    of its parts, and with it on how the rows are dealt to tasks.
    """
    if rows.schema[amount].dataType.typeName() not in ("double", "float"):
        return F.round(F.sum(amount), 2)
    return F.round(F.sum(F.col(amount).cast("decimal(38,6)")), 2).cast("double")


def safe_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Rounded quotient, 0 where the denominator is not positive or is null."""
    quotient = F.round(numerator / denominator, scale)
    return F.when(denominator > 0, quotient).otherwise(F.lit(0))


def exact_cent_ratio(numerator: Column, denominator: Column) -> Column:
    """`safe_ratio` with two digits, worked out in whole cents and rounded half up.

    Engines differ in how they round a binary fraction that sits on a tie. Integer
    arithmetic has no such freedom, so this form gives one answer everywhere. Both
    inputs must be amounts with at most two digits after the point.
    """
    num, den = _cents(numerator), _cents(denominator)
    magnitude = F.call_function(
        "div", F.abs(num) * F.lit(200).cast("decimal(3,0)") + den, den * F.lit(2).cast("decimal(1,0)")
    )
    ratio = F.signum(num.cast("double")) * magnitude.cast("double") / F.lit(100.0)
    return F.when(den > 0, ratio).otherwise(F.lit(0.0))


def _cents(amount: Column) -> Column:
    return F.round(amount * 100, 0).cast("decimal(30,0)")
