"""Exact statistics that never bring a whole column into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
#: Cells that the bracket is divided into; only the values of a cell are ranked together.
CELLS = 1_000


def exact_median(frame: DataFrame, column: str) -> DataFrame:
    """One row with the exact median of `column`.

    A quantile sketch is off by at most rows / accuracy ranks, so two of them
    bracket the median: about 4 / accuracy of the rows. The bracket is divided into
    cells, whose counts give each cell its first rank.
    """
    values = frame.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    margin = 2.0 / SKETCH_ACCURACY
    sketch = values.agg(F.count("*").alias("n"), F.percentile_approx("v", [0.5 - margin, 0.5 + margin], SKETCH_ACCURACY).alias("q"))
    n = sketch.select("n").scalar()
    low, high = sketch.select(F.col("q")[0]).scalar(), sketch.select(F.col("q")[1]).scalar()
    below = values.where(F.col("v") < low).agg(F.count("*")).scalar()
    inside = values.where(F.col("v").between(low, high)).groupBy("v").agg(F.count("*").alias("copies"))
    cell = F.when(high > low, F.floor((F.col("v") - low) / (high - low) * CELLS)).otherwise(0)
    placed = inside.withColumn("cell", cell)
    earlier = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("cell").agg(F.sum("copies").alias("copies")).select("cell", (below + F.coalesce(F.sum("copies").over(earlier), F.lit(0))).alias("start"))
    ranked = placed.join(starts, "cell").select("v", (F.col("start") + F.sum("copies").over(Window.partitionBy("cell").orderBy("v"))).alias("last_rank"))
    lower_rank, upper_rank = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    return ranked.agg(
        (
            (F.min(F.when(F.col("last_rank") >= lower_rank, F.col("v")))
             + F.min(F.when(F.col("last_rank") >= upper_rank, F.col("v"))))
            / 2
        ).alias("median")
    )
