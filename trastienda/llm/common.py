"""What the text operators share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.sources.settle import settle

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that models never learn from (a null id counts as empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def located(frame: DataFrame, columns: list[Column]) -> DataFrame:
    """`columns` and `place`, which names a row's file and its position there, whatever else is equal.

    A frame that isn't a plain scan of files is written to the shared folder first.
    """
    where = F.concat_ws(":", F.col("m.file_path"), F.col("m.row_index"))
    try:
        return frame.select(frame.metadataColumn("_metadata").alias("m"), *columns).withColumn("place", where).drop("m")
    except AnalysisException:
        kept = settle(frame)
        return kept.select(kept.metadataColumn("_metadata").alias("m"), *columns).withColumn("place", where).drop("m")


def running_total(rows: DataFrame, group: str, size: str, order: str, ties: list[str]) -> tuple[DataFrame, DataFrame]:
    """Adds `before`: the sum of `size` over the rows of the group that come earlier by `order`, a hex hash.

    The hash deals every group, however large, into 256 x 4096 even leaves. Sums of leaves
    give each leaf its start, so that a window holds 256 nodes, 4096 leaves or the rows of one leaf.
    """
    from pyspark.sql import Window

    top, leaf = F.substring(order, 1, 2), F.substring(order, 3, 3)
    dealt = rows.withColumn("top", top).withColumn("leaf", leaf)
    leaves = dealt.groupBy(group, "top", "leaf").agg(F.sum(size).alias("leaf_size"))
    tops = leaves.groupBy(group, "top").agg(F.sum("leaf_size").alias("top_size"))
    earlier = lambda keys, by: Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    tops = tops.select(group, "top", F.coalesce(F.sum("top_size").over(earlier([group], ["top"])), none).alias("top_before"))
    leaves = leaves.select(group, "top", "leaf", F.coalesce(F.sum("leaf_size").over(earlier([group, "top"], ["leaf"])), none).alias("leaf_before"))
    starts = leaves.join(tops, [group, "top"]).select(group, "top", "leaf", (F.col("top_before") + F.col("leaf_before")).alias("start"))
    within = F.coalesce(F.sum(size).over(earlier([group, "top", "leaf"], [order, *ties])), none)
    return dealt.join(starts, [group, "top", "leaf"]).withColumn("before", F.col("start") + within).drop("top", "leaf", "start")
