"""Top lists per variant and how much they agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TIE_DIGITS = 12


def top_per_group(frame: DataFrame, group: str, value: str, tie_break: str, size: int) -> DataFrame:
    """The `size` largest values per group, ties by `tie_break`; NULL is never ranked.

    Values are compared to 12 decimals: the last bits of a double depend on the
    order in which a sum was formed. Spark keeps only `size` rows per group and
    task before the shuffle.
    """
    by_value = Window.partitionBy(group).orderBy(F.round(value, TIE_DIGITS).desc(), F.col(tie_break))
    return (
        frame.where(F.col(value).isNotNull())
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= size)
    )


def ranking_overlap(top: DataFrame, group: str, item: str, base: str) -> DataFrame:
    """Per group its ordered list, the items shared with `base`, and whether both are equal."""
    lists = top.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", item))), lambda r: r[item]).alias("ranking")
    )
    # the lists are one row per variant, so one window holds them all
    all_lists = Window.partitionBy(F.lit(1))
    return (
        lists.withColumn("_base", F.max(F.when(F.col(group) == base, F.col("ranking"))).over(all_lists))
        .where(F.col("_base").isNotNull())
        .select(
            group,
            "ranking",
            F.size(F.array_intersect("ranking", "_base")).alias("skus_shared_with_principal"),
            (F.col("ranking") == F.col("_base")).alias("same_ranking_as_principal"),
        )
    )
