"""Question 2: stores that ran out of stock for several days in the quarter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.functions.dates import days_inclusive
from trastienda.functions.text import distinct_list_of
from trastienda.operators.lookup import lookup
from trastienda.operators.runs import UNKNOWN_BREAKS, UNKNOWN_BRIDGES, zero_runs

PAIR = ["store_id", "sku_num"]
MORE_THAN_DAYS = 3
# Store states.
CONFIRMED, POSSIBLE, OUTSIDE = "confirmado", "posible_si_na_es_cero", "solo_contando_dias_fuera_del_trimestre"


def stockout_runs(
    inventory: DataFrame,
    dim_product: DataFrame,
    quarter_start: Column,
    quarter_end: Column,
    data_end: Column,
    more_than_days: int = MORE_THAN_DAYS,
) -> DataFrame:
    """Runs longer than `more_than_days` that touch the quarter, from daily stock."""
    runs = zero_runs(inventory, PAIR, "snapshot_date", "stock_qty")
    return long_runs(runs, dim_product, quarter_start, quarter_end, data_end, more_than_days)


def long_runs(
    runs: DataFrame,
    dim_product: DataFrame,
    quarter_start: Column,
    quarter_end: Column,
    data_end: Column,
    more_than_days: int = MORE_THAN_DAYS,
) -> DataFrame:
    """Of all runs those longer than `more_than_days` that touch the quarter.

    The length test uses the whole run; `days_in_quarter` is the part inside.
    """
    runs = runs.where(
        (F.col("run_days") > more_than_days)
        & (F.col("run_end") >= quarter_start)
        & (F.col("run_start") <= quarter_end)
    )
    names = dim_product.select("sku_num", "sku_erp", "product_name", F.lit(True).alias("_known"))
    inside = days_inclusive(F.greatest("run_start", quarter_start), F.least("run_end", quarter_end))
    return (
        lookup(runs, names, ["sku_num"])
        .where(F.col("_known"))
        .select(
            "variant",
            "store_id",
            "sku_num",
            "sku_erp",
            "product_name",
            "run_start",
            "run_end",
            "run_days",
            F.greatest(F.lit(0), inside).alias("days_in_quarter"),
            "na_days",
            (F.col("run_start") < quarter_start).alias("starts_before_quarter"),
            (F.col("run_end") == data_end).alias("censored_at_data_end"),
        )
    )


def stores_with_stockouts(runs: DataFrame, dim_store: DataFrame, more_than_days: int = MORE_THAN_DAYS) -> DataFrame:
    """One row per store with a run, its state and the products concerned."""
    strict = F.col("variant") == UNKNOWN_BREAKS
    bridged = F.col("variant") == UNKNOWN_BRIDGES
    long_inside = F.col("days_in_quarter") > more_than_days
    per_store = runs.groupBy("store_id").agg(
        F.count_if(strict & long_inside).alias("runs_confirmed"),
        F.count_if(bridged & long_inside).alias("runs_if_na_is_zero"),
        F.count_if(strict).alias("runs_counting_days_outside_quarter"),
        F.max(F.when(strict, F.col("days_in_quarter"))).alias("max_days_confirmed"),
        F.max(F.when(bridged, F.col("days_in_quarter"))).alias("max_days_if_na_is_zero"),
        distinct_list_of(F.col("sku_erp"), strict & long_inside).alias("skus_confirmed"),
        distinct_list_of(F.col("sku_erp"), bridged & long_inside).alias("skus_if_na_is_zero"),
        F.bool_or(F.col("censored_at_data_end") & long_inside).alias("has_run_censored_at_data_end"),
    )
    status = (
        F.when(F.col("runs_confirmed") > 0, CONFIRMED)
        .when(F.col("runs_if_na_is_zero") > 0, POSSIBLE)
        .otherwise(OUTSIDE)
    )
    return per_store.join(dim_store.select("store_id", "city"), "store_id").select(
        "store_id", "city", status.alias("status"), *[c for c in per_store.columns if c != "store_id"]
    )
