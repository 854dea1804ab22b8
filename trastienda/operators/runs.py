"""Runs of consecutive days without stock, from summaries of months that can be merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trastienda.functions.dates import days_inclusive

# How a run treats a day with unknown stock.
UNKNOWN_BREAKS = "na_rompe_racha"
UNKNOWN_BRIDGES = "na_entre_ceros_como_cero"


def day_bit(day: Column) -> Column:
    """A bit for the day of the month, the lowest for the first."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(day) - 1)


def empty_days(daily: DataFrame, keys: list[str], day: str, stock: str) -> DataFrame:
    """(keys, month, zero, unknown): the days without stock and with unknown stock of each key and month, as bits.

    `daily` holds one row per key and day. Days become a bit in the task that reads them, so what is
    shuffled are months, and a month that comes in parts is put together by `merged`.
    """
    bit, none = day_bit(F.col(day)), F.lit(0).cast("long")
    open_days = daily.where((F.col(stock) == 0) | F.col(stock).isNull())
    return open_days.groupBy(*keys, F.trunc(day, "MM").alias("month")).agg(
        F.bit_or(F.when(F.col(stock) == 0, bit).otherwise(none)).alias("zero"),
        F.bit_or(F.when(F.col(stock).isNull(), bit).otherwise(none)).alias("unknown"),
    )


def merged(months: DataFrame, keys: list[str]) -> DataFrame:
    """Summaries of parts of the days, in any order and number, as those of all days."""
    return months.groupBy(*keys, "month").agg(F.bit_or("zero").alias("zero"), F.bit_or("unknown").alias("unknown"))


def runs_of_months(months: DataFrame, keys: list[str]) -> DataFrame:
    """Every run of zero-stock days, under both readings of an unknown day.

    A month's stretches are read off its bits. Stretches that meet at the turn of a month belong together, so
    the sort per key holds a few stretches a month, and the grouping below reuses its partitioning.
    A bridged run starts and ends on a zero day; the days between that are not zero are unknown ones.
    """
    strict = F.struct(F.lit(UNKNOWN_BREAKS).alias("variant"), F.col("zero").alias("open"))
    bridged = F.struct(F.lit(UNKNOWN_BRIDGES).alias("variant"), F.col("zero").bitwiseOR(F.col("unknown")).alias("open"))
    edges = lambda shift: F.expr(f"filter(sequence(0, 30), x -> shiftright(open & ~{shift}(open, 1), x) & 1 = 1)")
    read = months.select(*keys, "month", "zero", F.inline(F.array(strict, bridged))).where("open <> 0")
    stretches = read.select(*keys, "month", "zero", "variant", F.inline(F.arrays_zip(edges("shiftleft").alias("first"), edges("shiftright").alias("last"))))
    zeros = F.expr("zero & (shiftleft(1L, last + 1) - shiftleft(1L, first))")
    on = lambda place: F.date_add("month", place.cast("int"))
    lowest, highest = F.expr("bit_count((zeros & -zeros) - 1)"), F.length(F.bin("zeros")) - 1
    placed = stretches.withColumn("zeros", zeros).select(
        *keys,
        "variant",
        on(F.col("first")).alias("_first"),
        on(F.col("last")).alias("_last"),
        F.when(F.col("zeros") > 0, on(lowest)).alias("_first_zero"),
        F.when(F.col("zeros") > 0, on(highest)).alias("_last_zero"),
        F.bit_count("zeros").alias("_zeros"),
    )
    in_order = Window.partitionBy(*keys).orderBy("variant", "_first")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    goes_on = (F.lag("variant").over(in_order) == F.col("variant")) & (F.date_add(F.lag("_last").over(in_order), 1) == F.col("_first"))
    numbered = placed.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(so_far))
    length = days_inclusive(F.col("run_start"), F.col("run_end"))
    return (
        numbered.groupBy(*keys, "variant", "_run")
        .agg(F.min("_first_zero").alias("run_start"), F.max("_last_zero").alias("run_end"), F.sum("_zeros").alias("zero_days"))
        .where(F.col("zero_days") > 0)
        .select("variant", *keys, "run_start", "run_end", length.alias("run_days"), (length - F.col("zero_days")).alias("na_days"))
    )


def zero_runs(daily: DataFrame, keys: list[str], day: str, stock: str) -> DataFrame:
    """Every run of zero-stock days of a table with one row per key and day."""
    return runs_of_months(empty_days(daily, keys, day, stock), keys)
