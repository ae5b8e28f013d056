"""Dates: lenient parsing, partition columns, dated folders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.contracts import DATE_PARTS

FOLDER_PATTERN = "yyyy/MM/dd"
FOLDER_REGEX = r"(\d{4}/\d{2}/\d{2})"


def lenient_date(text: Column) -> Column:
    """ISO text to date; date-times keep their date; unreadable text gives null."""
    return text.try_cast("date")


def lenient_timestamp(text: Column) -> Column:
    """ISO text, with or without offset, to timestamp; unreadable text gives null."""
    return text.try_cast("timestamp")


def date_in_path(path: Column) -> Column:
    """The first yyyy/MM/dd found in a path, null where there is none."""
    return F.try_to_date(F.regexp_extract(path, FOLDER_REGEX, 1), FOLDER_PATTERN)


def publication_date(text: Column) -> Column:
    """Start date of an ad: its leading calendar date, whatever time or offset follows.

    The date is read in the offset it was written in, so a late evening start does
    not move to the next day. Compact dates (20260701) are accepted as well.
    """
    compact = F.when(
        text.rlike(r"^\d{8}(T.*)?$"), F.try_to_date(F.substring(text, 1, 8), "yyyyMMdd")
    )
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-M-d"), compact)


def utc_date(moment: Column) -> Column:
    """Calendar date of a moment in UTC as text, whatever the session's time zone."""
    return F.date_format(_in_utc(moment), "yyyy-MM-dd")


def utc_iso(moment: Column) -> Column:
    """A moment as ISO text with microseconds and UTC offset."""
    clock = F.date_format(_in_utc(moment), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(clock, F.lit("+00:00"))


def _in_utc(moment: Column) -> Column:
    return F.to_utc_timestamp(moment.cast("timestamp"), F.current_timezone())


def with_date_parts(df: DataFrame, day: str = "fecha") -> DataFrame:
    """Add the year, month and day partition columns."""
    year, month, dom = DATE_PARTS
    return df.withColumns(
        {year: F.year(day), month: F.month(day), dom: F.dayofmonth(day)}
    )


def between_days(start: date | None, end: date | None, day: str = "fecha") -> Column:
    """Inclusive range on ``fecha`` repeated on the partition columns.

    A predicate on the date column alone skips no folder of a table laid out by
    year, month and day; the integer form lets Spark prune them before reading.
    """
    year, month, dom = (F.col(c) for c in DATE_PARTS)
    stored = year * 10000 + month * 100 + dom
    condition = in_days(start, end, day)
    if start is not None:
        condition = condition & (stored >= _yyyymmdd(start))
    if end is not None:
        condition = condition & (stored <= _yyyymmdd(end))
    return condition


def in_days(start: date | None, end: date | None, day: str | Column = "fecha") -> Column:
    """Inclusive range on a date column; an open end is None."""
    condition, day = F.lit(True), F.col(day) if isinstance(day, str) else day
    if start is not None:
        condition = condition & (day >= F.lit(start))
    if end is not None:
        condition = condition & (day <= F.lit(end))
    return condition


def on_days(days: list[date], stored_in_parts: bool = False) -> Column:
    """Some single days, repeated on the partition columns of a table laid out by them, so
    that Spark reads the folders of these days alone."""
    condition = F.col("fecha").isin(days) if days else F.lit(False)
    if not stored_in_parts or not days:
        return condition
    year, month, dom = (F.col(c) for c in DATE_PARTS)
    return condition & (year * 10000 + month * 100 + dom).isin([_yyyymmdd(d) for d in days])


def _yyyymmdd(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def dated_folder(layer: str, dataset: str, day: date) -> str:
    """Relative folder of one day, for example landing/ventas/2026/07/15."""
    return f"{layer}/{dataset}/{day:%Y/%m/%d}"


def dated_path(layer: str, dataset: str, day: Column, filename: Column) -> Column:
    """The same rule as a column, one path per row."""
    return F.concat_ws(
        "/", F.lit(layer), F.lit(dataset), F.date_format(day, FOLDER_PATTERN), filename
    )
