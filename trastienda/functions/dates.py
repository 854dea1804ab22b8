"""Dates and local timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
OPEN_END = "9999-12-31"


def local_timestamp(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` as wall-clock time, NULL for anything else."""
    return F.when(text.rlike(STAMP), text.try_cast("timestamp_ntz"))


def plain_date(text: Column) -> Column:
    """`yyyy-MM-dd`, NULL for anything else."""
    return F.when(text.rlike(DAY), text.try_cast("date"))


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def quarter_of(day: Column) -> Column:
    return F.trunc(day, "QUARTER")


def days_inclusive(first: Column, last: Column) -> Column:
    return F.datediff(last, first) + 1
