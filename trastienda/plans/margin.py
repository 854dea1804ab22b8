"""Question 4: products sold below cost, and the stores where that happens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.functions.amounts import percent, ratio, without_tax
from trastienda.functions.text import list_of
from trastienda.plans.core import EXPLICIT, ONLINE, PHYSICAL

# The store label of web orders and the variant names.
ONLINE_STORE = "ECOMMERCE"
PRINCIPAL, EXPLICIT_ONLY, TAX_INCLUDED = "principal", "solo_mapeo_explicito", "precio_incluye_iva_16"
ROUNDED = "decimal(24,2)"


def margin_by_product_store(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Units, revenue, cost and margin per product, store and channel; sums first, names after."""
    sold = F.col("sales_sign") == 1
    below_cost = F.col("original_amount") * F.col("fx_rate") < F.col("qty") * F.col("unit_cost_mxn")
    sums = (
        sales.where(F.col("sales_sign") != 0)
        .groupBy("sku_num", F.coalesce("store_id", F.lit(ONLINE_STORE)).alias("store_id"), "channel")
        .agg(
            F.sum("qty_net").alias("units_net"),
            F.sum("revenue_mxn_net").alias("revenue"),
            F.sum("cost_mxn_net").alias("cost"),
            F.sum("margin_mxn_net").alias("margin"),
            F.count_if(sold & below_cost).alias("sale_lines_below_cost"),
            F.count_if(sold).alias("sale_lines"),
        )
    )
    names = dim_product.select("sku_num", "sku_pos", "sku_erp", "product_name", "pos_erp_link_source")
    return sums.join(names, "sku_num").select(
        "sku_num",
        "sku_pos",
        "sku_erp",
        "product_name",
        "pos_erp_link_source",
        "store_id",
        "channel",
        "units_net",
        F.round("revenue", 2).alias("revenue_mxn"),
        F.round("cost", 2).alias("cost_mxn"),
        F.round("margin", 2).alias("margin_mxn"),
        percent(F.col("margin"), F.col("revenue")).alias("margin_pct"),
        F.round(without_tax(F.col("revenue")) - F.col("cost").cast("double"), 2).alias(
            "margin_mxn_if_price_includes_iva"
        ),
        "sale_lines_below_cost",
        "sale_lines",
    )


def margin_variants(by_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Products negative in at least one store, under three assumptions.

    The rounded store margins are added up, so the product figure is the sum of
    what is published. One grouping by product yields all variants, which are unfolded after it.
    """

    def reading(variant: str, margin: Column, revenue: Column, counts: Column | None = None) -> Column:
        only = lambda value: value if counts is None else F.when(counts, value)
        margin, negative = margin.cast(ROUNDED), margin.cast(ROUNDED) < 0
        return F.struct(
            F.lit(variant).alias("variant"),
            F.sum(only(margin)).alias("margin"),
            F.sum(only(revenue.cast(ROUNDED))).alias("revenue"),
            F.count_if(only(negative)).alias("stores_negative"),
            F.count(only(F.lit(1))).alias("stores_selling"),
            list_of(F.col("store_id"), negative if counts is None else negative & counts).alias("negative_store_ids"),
        )

    explicit = ((F.col("channel") == PHYSICAL) & (F.col("pos_erp_link_source") == EXPLICIT)) | (
        (F.col("channel") == ONLINE) & (F.col("handle_link_source") == EXPLICIT)
    )
    margin, revenue = F.col("margin_mxn"), F.col("revenue_mxn")
    as_published = reading(PRINCIPAL, margin, revenue)
    taxed = reading(TAX_INCLUDED, F.col("margin_mxn_if_price_includes_iva"), F.round(without_tax(revenue), 2))
    mapped = reading(EXPLICIT_ONLY, margin, revenue, explicit)
    links = dim_product.select("sku_num", "handle_link_source")
    per_product = (
        by_store.join(links, "sku_num")
        .groupBy("sku_num")
        .agg(
            F.max("sku_pos").alias("sku_pos"),
            F.max("product_name").alias("product_name"),
            F.array(as_published, taxed, mapped).alias("readings"),
        )
        .select("sku_num", "sku_pos", "product_name", F.inline("readings"))
    )
    return per_product.where(F.col("stores_negative") > 0).select(
        "variant",
        "sku_num",
        "sku_pos",
        "product_name",
        F.col("margin").cast("double").alias("product_margin_mxn"),
        F.round(ratio(F.col("margin") * 100, F.col("revenue")), 2).alias("product_margin_pct"),
        "stores_negative",
        "stores_selling",
        "negative_store_ids",
    )


def negative_margin_products(variants: DataFrame) -> DataFrame:
    return variants.where(F.col("variant") == PRINCIPAL).drop("variant")


def negative_margin_by_store(by_store: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Store and product pairs sold at a loss, with the city of the store.

    Web sales share one label that is no store; their rows are spread by product instead.
    """
    no_store = F.concat(F.lit("sku-"), F.col("sku_num").cast("string"))
    place = F.when(F.col("channel") == ONLINE, no_store).otherwise(F.col("store_id"))
    cities = dim_store.select(F.col("store_id").alias("_place"), "city")
    return (
        by_store.where(F.col("margin_mxn") < 0)
        .withColumn("_place", place)
        .join(cities, "_place", "left")
        .withColumn("city", F.when(F.col("channel") != ONLINE, F.col("city")))
        .select(
            "sku_num",
            "sku_pos",
            "product_name",
            "pos_erp_link_source",
            "store_id",
            "city",
            "units_net",
            "revenue_mxn",
            "cost_mxn",
            "margin_mxn",
            "margin_pct",
            "sale_lines_below_cost",
            "sale_lines",
        )
    )
