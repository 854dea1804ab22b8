"""Mix sources to target weights by a curriculum whose weights change over the training.

Each source has a schedule of weights over training time 0 to 1, given as knots of a
piecewise linear curve. The integral of the curve is the source's share. Shares become
word targets: no source is repeated more than `most` times, and what such a source
can't give is shared out among the others by weight. A document's words lie at a place in
its source's cumulative demand; inverting the integral of the schedule gives the time at
which that demand is reached, which is the document's position in the training.

Main path: DataFrame functions only.

Defined cases: null text has size 0, a null source is a source of its own (last by name),
repeated rows are documents of their own, ties in the order of a source fall to the doc_id
and then the size, an empty table gives an empty mix, other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trastienda.llm.common import WORD, running_total, text_of
from trastienda.sources.settle import settle

Knots = Sequence[tuple[float, float]]
#: Weights over time of the first, second, third source by name, repeating; their integrals are 5, 2 and 1.
SCHEDULES: tuple[Knots, ...] = (((0.0, 7.0), (1.0, 3.0)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)))
MOST = 3


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), 0)).cast("long")


def integral(knots: Knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))


def targets(sized: DataFrame, schedules: Sequence[Knots] = SCHEDULES, most: int = MOST) -> DataFrame:
    """(source_key, rank, source_size, target): one row per source.

    In the order of size by weight, the sources that reach their cap come first. So one
    window finds them all: a source is capped if its share of what is left, after the
    caps of all before it, is at least its own cap.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(integral(k))) for k in schedules])
    sources = (
        sized.groupBy("source_key", "source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(every) - 1)
        .withColumn("weight", F.element_at(kinds, F.col("rank") % len(schedules) + 1))
        .withColumn("cap", (most * F.col("source_size")).cast("double"))
    )
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumns(
        {
            "total": F.sum("source_size").over(whole).cast("double"),
            "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(after),
        }
    ).withColumn("capped", F.col("cap") * F.col("open") <= F.col("weight") * F.col("left"))
    sources = sources.withColumns(
        {
            "fixed": F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(whole),
            "shared": F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(whole),
        }
    )
    share = F.col("weight") * (F.col("total") - F.col("fixed")) / F.col("shared")
    target = F.when(F.col("capped"), F.col("cap")).otherwise(share)
    return sources.select("source_key", "rank", "source_size", target.alias("target"))


def time_of(part: Column, rank: Column, schedules: Sequence[Knots] = SCHEDULES) -> Column:
    """The training time at which a source's demand has reached `part` (0 to 1) of its target.

    On a piece of the curve the demand is a square polynomial of the time, so its inverse has a closed form.
    """
    time = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        total, reached = integral(knots), 0.0
        inverse = F.lit(float(knots[-1][0]))
        pieces = []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
            pieces.append((t0, w0, (w1 - w0) / (t1 - t0), reached / total))
            reached += (t1 - t0) * (w0 + w1) / 2
        for t0, w0, slope, start in pieces:
            area = (part - F.lit(start)) * F.lit(total)
            if slope:
                here = F.lit(t0) + (F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * area) - F.lit(w0)) / F.lit(slope)
            else:
                here = F.lit(t0) + area / F.lit(w0)
            inverse = here if start == 0 else F.when(part < F.lit(start), inverse).otherwise(here)
        time = F.when(rank % len(schedules) == k, inverse).otherwise(time)
    return time


def mix(docs: DataFrame, carry: Sequence[str] | None = None, schedules: Sequence[Knots] = SCHEDULES, most: int = MOST) -> DataFrame:
    """One row per document: `row` (its columns, or those in `carry`), size, source_size, target, copies, taken,
    and `times`, the training time of each copy.

    A source's documents stand in the order of a hash. Whole passes take all of them; the
    last pass takes those whose middle lies before the end of the target.
    """
    kept = [F.col(c) for c in (docs.columns if carry is None else carry)]
    sized = docs.select(
        F.struct(*kept).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        F.col("source"),
        F.col("doc_id").alias("doc_id"),
        word_count(text_of()).alias("size"),
        F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("deal"),
    )
    if carry is not None:  # narrow rows are counted once
        sized = settle(sized)
    goal = targets(sized.select("source_key", "source", "size"), schedules, most)
    placed = running_total(sized.drop("source"), "source_key", "size", "deal", ["doc_id", "size"]).join(goal, "source_key")
    middle = F.col("before") + F.col("size") / 2
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    copies = passes + F.when(middle < F.col("target") - passes * F.col("source_size"), 1).otherwise(0)
    placed = placed.withColumn("copies", copies.cast("int"))
    at = lambda copy: time_of(F.least((copy * F.col("source_size") + middle) / F.col("target"), F.lit(1.0)), F.col("rank"), schedules)
    times = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), at)).otherwise(F.array().cast("array<double>"))
    return placed.select("row", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), times.alias("times"))


def by_time(mixed: DataFrame) -> DataFrame:
    """The documents of a mix range-sorted by the time of their first copy; those that aren't taken come last."""
    first = F.get("times", F.lit(0)).asc_nulls_last()
    return settle(mixed).repartitionByRange(first).sortWithinPartitions(first)


def training_order(docs: DataFrame, schedules: Sequence[Knots] = SCHEDULES, most: int = MOST) -> DataFrame:
    """The mix itself: the documents' columns, a row for each copy, range-sorted by training time."""
    copies = mix(docs, schedules=schedules, most=most).select("row", F.explode("times").alias("time"))
    return copies.repartitionByRange("time").sortWithinPartitions("time").select("row.*")
