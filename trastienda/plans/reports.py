"""The presentation tables of a run, read from the result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.functions.text import list_of
from trastienda.operators.ranking import TIE_DIGITS
from trastienda.plans import growth, rotation
from trastienda.plans.core import ONLINE, PHYSICAL

Tables = dict[str, DataFrame]

# The Spanish headings of the presentation tables.


def checks_passed(tables: Tables) -> DataFrame:
    """Checks of the latest run, and how many passed."""
    results = tables["audit.quality_results"]
    latest = results.agg(F.max("run_id")).scalar()
    return results.where(F.col("run_id") == latest).agg(
        F.count("*").alias("total"), F.count_if(F.col("passed")).alias("passed")
    )


def top_products(tables: Tables) -> DataFrame:
    top = tables["mart.q1_top10_variants"].where(F.col("variant") == rotation.PRINCIPAL).select("sku_num", "rank")
    return tables["mart.q1_rotation_by_sku"].join(F.broadcast(top), "sku_num").select(  # ten rows
        "rank",
        F.col("sku_pos").alias("sku"),
        F.col("product_name").alias("producto"),
        F.round("rotation", 4).alias("rotacion"),
        F.col("units_net_tracked").alias("unidades_netas"),
        F.round("avg_stock", 1).alias("inventario_prom_suma_tiendas"),
        F.round("days_of_inventory", 0).alias("dias_inventario"),
        F.col("stores_tracked").alias("tiendas"),
        F.col("pos_erp_link_source").alias("mapeo"),
    ).orderBy("rank")


def rank_boundary(by_sku: DataFrame, size: int = rotation.TOP_SIZE) -> DataFrame:
    """The last product inside the top list and the first outside it."""
    ordered = by_sku.orderBy(F.round("rotation", TIE_DIGITS).desc_nulls_last(), "sku_num")
    return ordered.offset(size - 1).limit(2).select("sku_pos", "rotation")


def rankings(tables: Tables) -> DataFrame:
    return (
        tables["mart.q1_variant_summary"]
        .orderBy(F.col("variant") != rotation.PRINCIPAL, "variant")
        .select(
            F.col("variant").alias("variante"),
            F.to_json("ranking").alias("ranking_sku_num"),
            F.col("skus_shared_with_principal").alias("comparte_con_principal"),
            F.col("same_ranking_as_principal").alias("mismo_orden"),
        )
    )


def stockout_stores(tables: Tables) -> DataFrame:
    return tables["mart.q2_stores_with_stockouts"].orderBy("status", "store_id").select(
        F.col("store_id").alias("tienda"),
        F.col("city").alias("ciudad"),
        F.col("status").alias("estado"),
        F.col("skus_confirmed").alias("skus_confirmados"),
        F.col("skus_if_na_is_zero").alias("skus_si_na_es_cero"),
        F.col("max_days_confirmed").alias("dias_max_confirmados"),
        F.col("max_days_if_na_is_zero").alias("dias_max_si_na_es_cero"),
    )


def stockout_runs(tables: Tables) -> DataFrame:
    return tables["mart.q2_stockout_runs"].orderBy("variant", "store_id").select(
        F.col("variant").alias("variante"),
        F.col("store_id").alias("tienda"),
        "sku_erp",
        F.col("product_name").alias("producto"),
        F.col("run_start").cast("string").alias("inicio"),
        F.col("run_end").cast("string").alias("fin"),
        F.col("days_in_quarter").alias("dias_en_trimestre"),
        F.col("na_days").alias("dias_na"),
        F.col("censored_at_data_end").alias("corta_en_fin_de_datos"),
    )


def _cell(where: Column, value: str, name: str) -> Column:
    return F.max(F.when(where, F.col(value))).alias(name)


def months_by_channel(mom: DataFrame) -> DataFrame:
    def of(channel: str) -> Column:
        return F.col("channel") == channel

    return (
        mom.groupBy(F.date_format("month", "yyyy-MM").alias("mes"))
        .agg(
            _cell(of(PHYSICAL), "sales_mxn", "fisico_mxn"),
            _cell(of(PHYSICAL), "mom_growth_pct", "fisico_mom_pct"),
            _cell(of(ONLINE), "sales_mxn", "ecommerce_mxn"),
            _cell(of(ONLINE), "mom_growth_pct", "ecommerce_mom_pct"),
            _cell(of(ONLINE), "growth_note", "nota_ecommerce"),
            _cell(of(growth.TOTAL_CHANNEL), "mom_growth_pct", "total_mom_pct"),
        )
        .orderBy("mes")
    )


def months_by_variant(variants: DataFrame) -> DataFrame:
    def of(variant: str, channel: str) -> Column:
        return (F.col("variant") == variant) & (F.col("channel") == channel)

    return (
        variants.groupBy(F.date_format("month", "yyyy-MM").alias("mes"))
        .agg(
            _cell(of(growth.PRINCIPAL, PHYSICAL), "mom_growth_pct", "fisico_principal"),
            _cell(of(growth.ALL_TYPES, PHYSICAL), "mom_growth_pct", "fisico_todos_los_tipos"),
            _cell(of(growth.INCOME_ONLY, PHYSICAL), "mom_growth_pct", "fisico_solo_ingresos"),
            _cell(of(growth.PRINCIPAL, ONLINE), "mom_growth_pct", "ecommerce_principal"),
            _cell(of(growth.IF_UTC, ONLINE), "mom_growth_pct", "ecommerce_si_utc"),
        )
        .orderBy("mes")
    )


def negative_products(tables: Tables) -> DataFrame:
    return tables["mart.q4_negative_margin_products"].orderBy("product_margin_mxn").select(
        F.col("sku_pos").alias("sku"),
        F.col("product_name").alias("producto"),
        F.col("product_margin_mxn").alias("margen_mxn"),
        F.col("product_margin_pct").alias("margen_pct"),
        F.col("stores_negative").alias("tiendas_negativas"),
        F.col("stores_selling").alias("tiendas_que_venden"),
    )


def negative_stores(by_store: DataFrame) -> DataFrame:
    """Per product its losing stores; one product has at most as many as there are stores."""
    return (
        by_store.groupBy(F.col("sku_pos").alias("sku"))
        .agg(
            list_of(F.col("store_id")).alias("tiendas"),
            F.round(F.min("margin_pct"), 1).alias("margen_pct_min"),
            F.round(F.max("margin_pct"), 1).alias("margen_pct_max"),
            F.max("pos_erp_link_source").alias("mapeo"),
        )
        .orderBy("sku")
    )


def margin_variants(variants: DataFrame) -> DataFrame:
    """Per variant its losing products, one per row, beside the variant's losing pairs.

    A variant can lose on every product, so the products stay rows instead of one
    text.
    """
    pairs = variants.groupBy("variant").agg(F.sum("stores_negative").alias("combinaciones_negativas"))
    return variants.join(F.broadcast(pairs), "variant").select(  # one row per variant, three at most
        F.col("variant").alias("variante"),
        F.col("sku_pos").alias("producto_negativo"),
        "combinaciones_negativas",
    )


def below_cost_elsewhere(by_store: DataFrame, negative: DataFrame) -> DataFrame:
    """Lines sold below cost of products that are not on the losing list."""
    return (
        by_store.groupBy("sku_num")
        .agg(F.sum("sale_lines_below_cost").alias("lines"))
        .join(negative.select("sku_num"), "sku_num", "left_anti")
        .agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("sale_lines_below_cost"))
    )


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "checks_passed": checks_passed,
    "q1_top_products": top_products,
    "q1_rank_boundary": lambda t: rank_boundary(t["mart.q1_rotation_by_sku"]),
    "q1_rankings": rankings,
    "q2_stores": stockout_stores,
    "q2_runs": stockout_runs,
    "q3_months_by_channel": lambda t: months_by_channel(t["mart.q3_mom_growth"]),
    "q3_months_by_variant": lambda t: months_by_variant(t["mart.q3_monthly_variants"]),
    "q4_products": negative_products,
    "q4_stores": lambda t: negative_stores(t["mart.q4_negative_margin_by_store"]),
    "q4_variants": lambda t: margin_variants(t["mart.q4_margin_variants"]),
    "q4_below_cost_elsewhere": lambda t: below_cost_elsewhere(
        t["mart.q4_margin_by_product_store"], t["mart.q4_negative_margin_products"]
    ),
}
