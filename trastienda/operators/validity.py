"""Values that hold from a date on: intervals, and the value valid on a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trastienda.functions.dates import OPEN_END

#: Days of a cell; a fact meets the intervals of its key that touch its cell.
CELL_DAYS = 32
#: Cells whose presence one number tells.
BLOCK_CELLS = 64


def validity_intervals(frame: DataFrame, key: str, valid_from: str) -> DataFrame:
    """Add `valid_to`: the day before the next start of the same key, or the open end."""
    by_start = Window.partitionBy(key).orderBy(F.col(valid_from).asc_nulls_last())
    return frame.withColumn(
        "valid_to",
        F.coalesce(
            F.date_sub(F.lead(valid_from).over(by_start), 1),
            F.lit(OPEN_END).cast("date"),
        ),
    )


def asof(facts: DataFrame, intervals: DataFrame, key: str, day: str, also: DataFrame | None = None, cell_days: int = CELL_DAYS) -> DataFrame:
    """Left join to every interval of the key that holds the day.

    Sources with repeated keys or dates may give several; each is a row, whichever way the
    join is carried out. Intervals that end before they start hold no day. With `also`, the
    facts are left joined to its rows of the key in the same join.

    The days of a key are cut into cells, so a key with many facts or many intervals is many
    small groups. Every interval is handed to the cells that it touches, and only to those in
    which its key has facts: an open interval or a wrong date adds no cells. The cells of a key are
    gathered as bits, so they are told with a row or two per key, and meet the key's rows there. The lists are
    bounded: cells of a key by the calendar, steps of a key by their start days for each repetition of the key.
    """

    def cell(date: Column) -> Column:
        return F.floor(F.unix_date(date) / cell_days)

    values = [c for c in intervals.columns if c not in (key, "valid_from", "valid_to")]
    sold = facts.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), cell(F.col(day)).alias("_cell"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_cell", F.lit(BLOCK_CELLS)).cast("int"))
    blocks = sold.groupBy("_key", F.floor(F.col("_cell") / BLOCK_CELLS).alias("block")).agg(F.bit_or(bit).alias("bits"))
    met_by = blocks.groupBy("_key").agg(F.collect_list(F.struct("block", "bits")).alias("_blocks"))
    steps = intervals.where(F.col("valid_from") <= F.col("valid_to")).groupBy(F.col(key).alias("_key")).agg(
        F.collect_list(F.struct("valid_from", "valid_to", *values)).alias("_all")
    )
    added = []
    if also is None:
        known = met_by.join(steps, "_key")
    else:
        added = [c for c in also.columns if c != key]
        known = met_by.join(also.withColumnRenamed(key, "_key"), "_key", "left").join(steps, "_key", "left")
    touching = F.filter("_all", lambda step: F.col("_cell").between(cell(step["valid_from"]), cell(step["valid_to"])))
    in_cells = known.select("_key", *added, "_all", F.explode(F.flatten(F.transform("_blocks", _cells))).alias("_cell"))
    handed = in_cells.select("_key", "_cell", *added, touching.alias("_steps"))
    if also is None:
        handed = handed.where(F.size("_steps") > 0)
    met = facts.join(handed, (F.col(key) == F.col("_key")) & cell(F.col(day)).eqNullSafe(F.col("_cell")), "left")
    holds = F.filter("_steps", lambda step: F.col(day).between(step["valid_from"], step["valid_to"]))
    unfolded = met.select(*facts.columns, *added, F.explode_outer(holds).alias("_step"))
    return unfolded.select(*facts.columns, *added, *[F.col("_step")[c].alias(c) for c in values])


def _cells(block: Column) -> Column:
    """The cells that a block's bits stand for; facts without a day have a cell of their own, which no interval touches."""
    places = F.array(*[F.lit(n) for n in range(BLOCK_CELLS)])
    held = F.filter(places, lambda n: F.call_function("shiftright", block["bits"], n).bitwiseAND(F.lit(1)) == 1)
    none = F.array(F.lit(None).cast("bigint"))
    return F.when(block["bits"].isNull(), none).otherwise(F.transform(held, lambda n: block["block"] * BLOCK_CELLS + n))
