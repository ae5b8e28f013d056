"""Sales volume expected from a day's total spend.

Fixed values: the curve's ceiling, its rate, the daily and hourly floors and the
number of selling hours.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CEILING = 180
RATE = 0.00015
DAILY_FLOOR = 10
HOURLY_FLOOR = 1
SELLING_HOURS = 16


def daily_sales(spend: Column) -> Column:
    """Saturating response: grows with spend, flattens towards the ceiling."""
    expected = F.lit(float(CEILING)) * (1 - F.exp(F.lit(-RATE) * spend.cast("double")))
    return F.greatest(F.lit(DAILY_FLOOR), expected.cast("int"))


def hourly_sales(spend: Column) -> Column:
    """The daily volume spread over the selling hours, never below one."""
    return F.greatest(
        F.lit(HOURLY_FLOOR), (daily_sales(spend) / F.lit(SELLING_HOURS)).cast("int")
    )
