"""Compare what a model holds with control totals of its source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = ("amount", "qty", "n")
AMOUNT_TOLERANCE = "0.005"


def totals_by_dimension(totals: DataFrame, source: str, kind: str) -> DataFrame:
    """Long control totals of one source, one row per dimension value."""
    metrics = {f"amount_by_{kind}": "amount", f"qty_by_{kind}": "qty", f"rows_by_{kind}": "n"}
    wide = (
        totals.where((F.col("source") == source) & (F.col("dimension") != ""))
        .groupBy("dimension")
        .pivot("metric", list(metrics))
        .agg(F.max("value"))
    )
    return wide.select(
        F.col("dimension").alias(kind), *[F.col(metric).alias(name) for metric, name in metrics.items()]
    )


def unreconciled(model: DataFrame, source: DataFrame, key: str, tolerance: str = AMOUNT_TOLERANCE) -> DataFrame:
    """Keys on either side whose amount, quantity or row count disagree; missing is zero."""
    left = model.select(key, *[F.col(m).alias(f"model_{m}") for m in MEASURES])
    right = source.select(key, *[F.col(m).alias(f"source_{m}") for m in MEASURES])
    zero = F.lit(0)
    both = left.join(right, key, "full_outer").select(
        key,
        *[F.coalesce(F.col(f"{side}_{m}"), zero).alias(f"{side}_{m}") for side in ("model", "source") for m in MEASURES],
    )
    return both.where(
        (F.abs(F.col("model_amount") - F.col("source_amount")) > F.lit(tolerance).cast("decimal(10,3)"))
        | (F.col("model_qty") != F.col("source_qty"))
        | (F.col("model_n") != F.col("source_n"))
    )
