"""Attach a lookup table to a large table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(facts: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Left join, with one meaning for every size of the table.

    Nothing is counted beforehand: once the table's bytes are known at run time, a small
    one is broadcast and the facts stay where they are; with a large one both sides are
    shuffled, and partitions of the facts that a hot key (or NULL) makes large are split.
    """
    return facts.join(dim, on, "left")
