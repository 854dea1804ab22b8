"""Question 1: how often stock turns over, and how the answer depends on assumptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.functions.amounts import ratio
from trastienda.functions.dates import days_inclusive
from trastienda.operators.ranking import ranking_overlap, top_per_group
from trastienda.plans.core import EXPLICIT, PHYSICAL

TOP_SIZE = 10
PRINCIPAL = "principal"


def rotation_by_sku(
    sales: DataFrame, inventory: DataFrame, dim_product: DataFrame, start: Column, end: Column
) -> DataFrame:
    """Units sold over mean stock per product, both over the store and product pairs with stock records.

    Stock and units are first reduced to one row per pair, on the same
    partitioning. A full join keeps pairs sold without stock records too, so one
    grouping gives the tracked and the overall units.
    """
    stock = (
        inventory.where(F.col("snapshot_date").between(start, end))
        .groupBy("store_id", "sku_num")
        .agg(
            F.avg("stock_qty").alias("stock"),
            F.avg(F.coalesce("stock_qty", F.lit(0))).alias("stock_if_zero"),
            F.count("stock_qty").alias("days_reported"),
            F.count("*").alias("days"),
        )
    )
    units = (
        sales.where((F.col("channel") == PHYSICAL) & F.col("sale_date").between(start, end))
        .groupBy("store_id", "sku_num")
        .agg(
            F.sum("qty_net").alias("net"),
            F.sum(F.when(F.col("sales_sign") == 1, F.col("qty")).otherwise(0)).alias("gross"),
        )
    )
    tracked = F.col("days").isNotNull()

    def tracked_sum(name: str) -> Column:
        return F.sum(F.when(tracked, F.coalesce(F.col(name), F.lit(0))))

    per_sku = (
        stock.join(units, ["store_id", "sku_num"], "full_outer")
        .groupBy("sku_num")
        .agg(
            F.count("days").alias("stores_tracked"),
            F.sum(F.col("days") - F.col("days_reported")).alias("store_days_not_reported"),
            F.sum("stock").alias("avg_stock"),
            F.sum("stock_if_zero").alias("avg_stock_if_zero"),
            tracked_sum("net").alias("units_net_tracked"),
            tracked_sum("gross").alias("units_gross_tracked"),
            F.coalesce(F.sum("net"), F.lit(0)).alias("units_all"),
        )
        .where(F.col("stores_tracked") > 0)
    )
    rotation = ratio(F.col("units_net_tracked"), F.col("avg_stock"))
    return per_sku.join(dim_product, "sku_num").select(
        "sku_num",
        "sku_pos",
        "sku_erp",
        "product_name",
        "category",
        "pos_erp_link_source",
        "stores_tracked",
        "store_days_not_reported",
        "units_net_tracked",
        "avg_stock",
        rotation.alias("rotation"),
        ratio(days_inclusive(start, end), rotation).alias("days_of_inventory"),
        (F.col("units_all") - F.col("units_net_tracked")).alias("units_net_untracked_pairs"),
        ratio(F.col("units_net_tracked"), F.col("avg_stock_if_zero")).alias("rotation_na_as_zero"),
        ratio(F.col("units_all"), F.col("avg_stock")).alias("rotation_all_store_sales"),
        ratio(F.col("units_gross_tracked"), F.col("avg_stock")).alias("rotation_gross"),
    )


def top_variants(rotation: DataFrame, size: int = TOP_SIZE) -> DataFrame:
    """The top list under each assumption, from one pass over the rotation table."""

    def reading(variant: str, value: Column) -> Column:
        return F.struct(F.lit(variant).alias("variant"), value.alias("rotation_value"))

    # Variant names.
    readings = F.array(
        reading(PRINCIPAL, F.col("rotation")),
        reading("na_como_cero", F.col("rotation_na_as_zero")),
        reading("numerador_todas_las_tiendas", F.col("rotation_all_store_sales")),
        reading("bruto_sin_restar_devoluciones", F.col("rotation_gross")),
        reading(
            "solo_mapeo_explicito", F.when(F.col("pos_erp_link_source") == EXPLICIT, F.col("rotation"))
        ),
    )
    candidates = rotation.select("sku_num", "sku_pos", "product_name", F.inline(readings))
    return top_per_group(candidates, "variant", "rotation_value", "sku_num", size).select(
        "variant", "rank", "sku_num", "sku_pos", "product_name", "rotation_value"
    )


def variant_summary(top: DataFrame) -> DataFrame:
    return ranking_overlap(top, "variant", "sku_num", PRINCIPAL)
