"""Ordered lists as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ", "


def joined(values: Column) -> Column:
    """Sorted list as text; an empty list is NULL."""
    return F.nullif(F.array_join(F.array_sort(values), SEPARATOR), F.lit(""))


def list_of(value: Column, where: Column | None = None) -> Column:
    """Aggregate: every value, sorted."""
    return joined(F.collect_list(value if where is None else F.when(where, value)))


def distinct_list_of(value: Column, where: Column | None = None) -> Column:
    """Aggregate: each value once, sorted."""
    return joined(F.collect_set(value if where is None else F.when(where, value)))
