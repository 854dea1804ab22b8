"""Silver: typed tables. One source row stays one row; what cannot be read is NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.functions.amounts import COST, MONEY, RATE
from trastienda.functions.dates import local_timestamp, plain_date
from trastienda.functions.keys import KeyFormats, key_number, slug
from trastienda.functions.literals import fixed_table
from trastienda.operators.validity import validity_intervals

# The tax authority's document types and how sales treat them.
DOC_TYPES = (
    ("I", "Ingreso", "venta", 1),
    ("E", "Egreso (devolución / nota de crédito)", "devolucion", -1),
    ("P", "Pago (complemento de pago)", "excluido_pago", 0),
    ("N", "Nómina", "excluido_nomina", 0),
    ("T", "Traslado", "excluido_traslado", 0),
)
DOC_TYPE_COLUMNS = "doc_type, sat_description, sales_treatment, sales_sign"

# Stock states.
REPORTED, NOT_REPORTED, UNRECOGNISED = "reportado", "no_reportado", "valor_no_reconocido"

LOCAL_ZONE_OFFSET_HOURS = 6
CAP_REPEATS = 3


def ref_doc_types(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, DOC_TYPES, DOC_TYPE_COLUMNS)


def pos_sales(raw: DataFrame, formats: KeyFormats = KeyFormats()) -> DataFrame:
    stamp = local_timestamp(F.col("fecha_hora"))
    return raw.select(
        F.col("venta_id").alias("sale_id"),
        stamp.alias("sale_ts"),
        stamp.cast("date").alias("sale_date"),
        F.col("tienda_id").alias("store_id"),
        F.col("sku").alias("sku_pos"),
        key_number(F.col("sku"), formats.pos, formats.number_type).alias("sku_num"),
        F.col("cantidad").try_cast("int").alias("qty"),
        F.col("monto").try_cast(MONEY).alias("amount"),
        F.col("moneda").alias("currency"),
        F.col("tipo_comprobante").alias("doc_type"),
    )


def ecommerce_orders(raw: DataFrame, formats: KeyFormats = KeyFormats()) -> DataFrame:
    """Typed orders without any personal column, and the date they had if stamps were UTC."""
    stamp = local_timestamp(F.col("fecha"))
    return raw.select(
        "order_id",
        stamp.alias("order_ts"),
        stamp.cast("date").alias("order_date"),
        if_utc(stamp).alias("order_date_if_utc"),
        F.col("product_handle").alias("handle"),
        key_number(F.col("product_handle"), formats.handle, formats.number_type).alias("handle_num"),
        F.col("cantidad").cast("int").alias("qty"),
        F.col("amount").cast(MONEY).alias("amount"),
        "currency",
    )


def if_utc(stamp):
    return (stamp - F.make_dt_interval(hours=F.lit(LOCAL_ZONE_OFFSET_HOURS))).cast("date")


def fx_rates(raw: DataFrame) -> DataFrame:
    return flag_rate_cap(
        raw.select(
            plain_date(F.col("fecha")).alias("rate_date"),
            "currency",
            F.col("rate_to_mxn").try_cast(RATE).alias("rate_to_mxn"),
        )
    )


def flag_rate_cap(rates: DataFrame, repeats: int = CAP_REPEATS) -> DataFrame:
    """Flag a currency's highest rate where that exact value occurs more than `repeats` times; NULL for an unreadable rate
    among more than `repeats` of them.

    Rates are counted by value, and the values of a currency shrink to the highest one with its count, so that no task
    holds a currency's rates, however often they are repeated.
    """
    values = rates.groupBy("currency", "rate_to_mxn").agg(F.count("*").alias("n"))
    rate = F.col("rate_to_mxn")
    tops = values.groupBy(F.col("currency").alias("_currency")).agg(
        F.max(F.when(rate.isNotNull(), F.struct(rate.alias("rate"), "n"))).alias("_top"), F.max(F.when(rate.isNull(), F.col("n"))).alias("_unread")
    )
    known = (rate == F.col("_top.rate")) & (F.col("_top.n") > repeats)
    unread = F.lit(None).cast("boolean") & (F.col("_unread") > repeats)
    flag = F.when(rate.isNull(), unread).otherwise(known)
    return rates.join(tops, F.col("currency").eqNullSafe(F.col("_currency")), "left").select(*rates.columns, flag.alias("is_suspected_cap"))


def stores(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("tienda_id").alias("store_id"),
        F.col("ciudad").alias("city"),
        F.col("region").alias("region_erp"),
        F.col("timezone").alias("timezone_erp"),
    )


def products(raw: DataFrame, formats: KeyFormats = KeyFormats()) -> DataFrame:
    return raw.select(
        "sku_erp",
        key_number(F.col("sku_erp"), formats.erp, formats.number_type).alias("sku_num"),
        F.col("nombre").alias("product_name"),
        F.col("categoria").alias("category"),
        slug(F.col("nombre")).alias("name_slug"),
    )


def cost_history(raw: DataFrame) -> DataFrame:
    """Cost intervals per product; the supplier may be a person and stays behind."""
    typed = raw.select(
        "sku_erp",
        plain_date(F.col("fecha_vigencia")).alias("valid_from"),
        F.col("costo_mxn").try_cast(COST).alias("unit_cost_mxn"),
    )
    return validity_intervals(typed, "sku_erp", "valid_from").select(
        "sku_erp", "valid_from", "valid_to", "unit_cost_mxn"
    )


def sku_mappings(raw: DataFrame, formats: KeyFormats = KeyFormats()) -> DataFrame:
    return raw.select(
        "sku_pos",
        "sku_erp",
        "handle",
        key_number(F.col("sku_pos"), formats.pos, formats.number_type).alias("sku_pos_num"),
        key_number(F.col("sku_erp"), formats.erp, formats.number_type).alias("sku_erp_num"),
        key_number(F.col("handle"), formats.handle, formats.number_type).alias("handle_num"),
    )


def inventory_snapshots(raw: DataFrame) -> DataFrame:
    """`N/A` is unknown, not zero; the JSON type tells a number from a text."""
    kind, value = F.col("cantidad_json_type"), F.col("cantidad_en_stock")
    return raw.select(
        plain_date(F.col("fecha")).alias("snapshot_date"),
        F.col("tienda_id").alias("store_id"),
        "sku_erp",
        F.when(kind == "int", value.try_cast("int")).alias("stock_qty"),
        F.when(kind == "int", REPORTED)
        .when((kind == "str") & (value == "N/A"), NOT_REPORTED)
        .otherwise(UNRECOGNISED)
        .alias("stock_status"),
        value.alias("stock_raw"),
    )
