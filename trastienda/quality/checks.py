"""The 54 checks of the three layers, folded into few passes per table.

Every function takes tables by `layer.table` name and returns one row
(check_name, violations) per check. Keys and text codes are grouped before any
join, so repeated values travel once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.functions.amounts import MONEY, RATE
from trastienda.functions.dates import days_inclusive, local_timestamp, plain_date
from trastienda.functions.keys import KeyFormats, differs, expected_handle
from trastienda.functions.literals import fixed_table
from trastienda.operators.reconcile import AMOUNT_TOLERANCE, totals_by_dimension, unreconciled
from trastienda.plans.core import INVENTORY, NATIVE_CURRENCY, NO_RATE, ONLINE, PHYSICAL
from trastienda.plans.growth import PRINCIPAL
from trastienda.plans.staging import NOT_REPORTED, REPORTED, UNRECOGNISED
from trastienda.quality.gate import WARN, Check, count_rows, measure, surplus_rows
from trastienda.quality.privacy import personal_columns, personal_values
from trastienda.sources.settle import settle_all

Tables = dict[str, DataFrame]
STAGING, CORE, MARTS = "staging", "core", "marts"
# The supported currencies and the tolerances of the mart checks.
CURRENCIES = ("MXN", "USD", "EUR")
MONTHS_TOLERANCE, MARGIN_TOLERANCE = "0.06", "0.01"

# Check names.
RAW_COUNTS = {
    "raw_pos_filas_vs_archivo": ("raw.pos_sales", "pos", "rows"),
    "raw_ecommerce_filas_vs_archivo": ("raw.ecommerce_orders", "ecommerce", "rows"),
    "raw_fx_filas_vs_archivo": ("raw.fx_rates", "fx", "rows"),
    "raw_snapshots_filas_vs_archivo": ("raw.erp_snapshots", "erp", "snapshots"),
    "raw_catalogo_filas_vs_archivo": ("raw.erp_products", "erp", "products"),
    "raw_mapeo_filas_vs_archivo": ("raw.erp_sku_mappings", "erp", "sku_mappings"),
    "raw_costos_filas_vs_archivo": ("raw.erp_cost_history", "erp", "cost_history"),
    "raw_tiendas_filas_vs_archivo": ("raw.erp_stores", "erp", "stores"),
}
CHECKS = [
    *[Check(name, STAGING, f"{table} has as many rows as its source.") for name, (table, _, _) in RAW_COUNTS.items()],
    Check("pos_campos_parseables", STAGING, "Stamp, quantity, amount, product number and store are readable."),
    Check("pos_venta_id_unico", STAGING, "Sale ids are unique."),
    Check("pos_moneda_mxn", STAGING, "Store sales are in the native currency."),
    Check("pos_tipo_comprobante_conocido", STAGING, "Document types are in the catalogue."),
    Check("pos_cantidad_y_monto_positivos", STAGING, "Store quantities and amounts are above zero."),
    Check("ecommerce_campos_parseables", STAGING, "Stamp, handle number, quantity and amount are readable."),
    Check("ecommerce_order_id_unico", STAGING, "Order ids are unique."),
    Check("ecommerce_moneda_conocida", STAGING, "Order currencies are supported."),
    Check("ecommerce_cantidad_y_monto_positivos", STAGING, "Order quantities and amounts are above zero."),
    Check("fx_parseable_y_positivo", STAGING, "Rates are dated and above zero."),
    Check("fx_llave_unica", STAGING, "One rate per day and currency."),
    Check("fx_cobertura", STAGING, "Every foreign order has a rate of its day."),
    Check("stock_valores_validos", STAGING, "Stock is a whole number from zero, or the text for unknown."),
    Check("snapshots_parseables", STAGING, "Snapshot dates are readable."),
    Check("snapshots_llave_unica", STAGING, "One snapshot per day, store and product."),
    Check("snapshots_grilla_completa", STAGING, "Every store and product pair has a snapshot on every day."),
    Check("catalogo_sku_formato", STAGING, "Catalogue keys have their format."),
    Check("catalogo_numero_unico", STAGING, "Catalogue numbers are unique."),
    Check("costos_parseables_y_positivos", STAGING, "Costs are dated and above zero."),
    Check("costos_sin_fechas_repetidas", STAGING, "One cost per product and start day."),
    Check("mapeo_explicito_mismo_numero", STAGING, "An explicit mapping joins equal numbers."),
    Check("mapeo_sku_pos_unico", STAGING, "A store code is mapped once."),
    Check("mapeo_handle_coincide_con_nombre", STAGING, "A mapped handle is the slug and number of its product."),
    Check("ecommerce_handle_coincide_con_nombre", STAGING, "A sold handle is the slug and number of its product."),
    Check("pos_sku_en_catalogo", STAGING, "Sold product numbers are in the catalogue."),
    Check("pos_sku_texto_unico_por_numero", STAGING, "A product number has one store code."),
    Check("snapshots_sku_en_catalogo", STAGING, "Products of snapshots are in the catalogue."),
    Check("tiendas_en_erp", STAGING, "Stores of sales and snapshots are known."),
    Check("fct_pos_filas_vs_archivo", CORE, "Every store sale of the source is in the fact."),
    Check("fct_pos_montos_vs_archivo", CORE, "Amount, quantity and rows per document type equal the source."),
    Check("fct_venta_fisica_neta_vs_archivo", CORE, "Net store sales equal income less returns of the source."),
    Check("fct_ecommerce_montos_vs_archivo", CORE, "Amount, quantity and rows per currency equal the source."),
    Check("fct_ecommerce_mxn_recalculado_desde_raw", CORE, "Converted web sales equal a recalculation from raw."),
    Check("fct_producto_vinculado", CORE, "Every line is linked to a product."),
    Check("fct_costo_vigente_asignado", CORE, "Every sale or return has a cost."),
    Check("fct_fx_asignado", CORE, "Every foreign order has a rate."),
    Check("inventario_vs_archivo", CORE, "Rows, unknowns and stock sum equal the source."),
    Check("dim_producto_numero_unico", CORE, "One product row per number."),
    Check("inventario_cubre_ventana_rotacion", CORE, "Snapshots cover the rotation window."),
    Check("inventario_cubre_trimestre", CORE, "Snapshots cover the quarter."),
    Check("fuentes_terminan_en_la_misma_fecha", CORE, "All sources end on the last day with data.", WARN),
    Check("q1_unidades_cuadran_con_fct", MARTS, "Tracked and untracked units equal the fact."),
    Check("q3_meses_cuadran_con_fct", MARTS, "Monthly sales equal the fact."),
    Check("q4_margen_cuadra_con_fct", MARTS, "Margins add up to the fact."),
    Check("pii_columnas_fuera_de_raw", MARTS, "No column outside raw is named like personal data."),
    Check("pii_valores_fuera_de_raw", MARTS, "No text outside raw looks like a tax number or an e-mail."),
]


def checks_of(layer: str) -> list[Check]:
    return [c for c in CHECKS if c.layer == layer]


def _one_row(frame: DataFrame, name: str, violations: Column) -> DataFrame:
    return measure(frame.agg(F.coalesce(violations, F.lit(0)).alias("v")), {name: F.col("v")})


def _total(totals: DataFrame, source: str, metric: str, dimension: str = "") -> Column:
    """One control total as a scalar; NULL if the source gave none."""
    return (
        totals.where((F.col("source") == source) & (F.col("metric") == metric) & (F.col("dimension") == dimension))
        .agg(F.max("value"))
        .scalar()
    )


def raw_counts(tables: Tables) -> DataFrame:
    counted = [
        tables[table].agg(F.count("*").alias("n")).select(
            F.lit(check).alias("check_name"), F.lit(source).alias("source"), F.lit(metric).alias("metric"), "n"
        )
        for check, (table, source, metric) in RAW_COUNTS.items()
    ]
    totals = tables["raw.source_totals"].where(F.col("dimension") == "").select("source", "metric", "value")
    return reduce(DataFrame.unionByName, counted).join(totals, ["source", "metric"], "left").select(
        "check_name", F.abs(F.col("n") - F.col("value")).cast("bigint").alias("violations")
    )


def pos_profile(pos: DataFrame) -> DataFrame:
    """Store sales by product, store and document type with the counts of all row conditions."""
    any_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("sale_ts", "qty", "amount", "sku_num", "store_id")])
    return pos.groupBy("sku_num", "sku_pos", "store_id", "doc_type").agg(
        F.count("*").alias("n"),
        F.count_if(any_missing).alias("unreadable"),
        F.count_if(differs(F.col("currency"), F.lit(NATIVE_CURRENCY))).alias("foreign"),
        F.count_if((F.col("qty") <= 0) | (F.col("amount") <= 0)).alias("not_positive"),
    )


def pos_checks(tables: Tables, profile: DataFrame) -> list[DataFrame]:
    known_type = tables["stg.ref_doc_types"].select("doc_type", F.lit(True).alias("_known"))
    typed = profile.join(F.broadcast(known_type), "doc_type", "left")  # a handful of constant rows
    total = lambda value: F.coalesce(F.sum(value), F.lit(0))
    sums = typed.agg(
        total("unreadable").alias("unreadable"),
        total("foreign").alias("foreign"),
        total(F.when(F.col("_known").isNull(), F.col("n"))).alias("untyped"),
        total("not_positive").alias("not_positive"),
    )
    per_number = profile.groupBy("sku_num").agg(F.min("sku_pos").alias("first_code"), F.max("sku_pos").alias("last_code"))
    catalogue = tables["stg.products"].select("sku_num").distinct().withColumn("_listed", F.lit(True))
    numbers = per_number.join(catalogue, "sku_num", "left").agg(
        F.count_if(F.col("sku_num").isNotNull() & F.col("_listed").isNull()).alias("absent"),
        F.count_if(F.col("first_code") != F.col("last_code")).alias("two_codes"),
    )
    return [
        measure(
            sums,
            {
                "pos_campos_parseables": F.col("unreadable"),
                "pos_moneda_mxn": F.col("foreign"),
                "pos_tipo_comprobante_conocido": F.col("untyped"),
                "pos_cantidad_y_monto_positivos": F.col("not_positive"),
            },
        ),
        surplus_rows(tables["stg.pos_sales"], "pos_venta_id_unico", ["sale_id"], null_is_key=False),
        measure(numbers, {"pos_sku_en_catalogo": F.col("absent"), "pos_sku_texto_unico_por_numero": F.col("two_codes")}),
    ]


def order_checks(tables: Tables, formats: KeyFormats) -> list[DataFrame]:
    orders, products = tables["stg.ecommerce_orders"], tables["stg.products"]
    any_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("order_ts", "handle_num", "qty", "amount")])
    foreign = (
        orders.where(F.col("currency") != NATIVE_CURRENCY)
        .groupBy(F.col("order_date").alias("rate_date"), "currency")
        .agg(F.count("*").alias("n"))
        .join(tables["stg.fx_rates"], ["rate_date", "currency"], "left")
    )
    sold = orders.groupBy("handle", F.col("handle_num").alias("sku_num")).agg(F.count("*").alias("n"))
    return [
        count_rows(
            orders,
            {
                "ecommerce_campos_parseables": any_missing,
                "ecommerce_moneda_conocida": ~F.col("currency").isin(*CURRENCIES) | F.col("currency").isNull(),
                "ecommerce_cantidad_y_monto_positivos": (F.col("qty") <= 0) | (F.col("amount") <= 0),
            },
        ),
        surplus_rows(orders, "ecommerce_order_id_unico", ["order_id"], null_is_key=False),
        _one_row(foreign, "fx_cobertura", F.sum(F.when(F.col("rate_to_mxn").isNull(), F.col("n")))),
        _one_row(
            with_expected_handle(sold, products, formats),
            "ecommerce_handle_coincide_con_nombre",
            F.sum(F.when(differs(F.col("handle"), F.col("expected")), F.col("n"))),
        ),
    ]


def with_expected_handle(handles: DataFrame, products: DataFrame, formats: KeyFormats) -> DataFrame:
    """Add the handle the product of each number must have; NULL without a product."""
    expected = products.select(
        "sku_num", expected_handle(F.col("name_slug"), F.col("sku_num"), formats.handle_digits).alias("expected")
    )
    return handles.join(expected, "sku_num", "left")


def fx_checks(tables: Tables) -> list[DataFrame]:
    fx = tables["stg.fx_rates"]
    bad = F.col("rate_date").isNull() | F.col("rate_to_mxn").isNull() | (F.col("rate_to_mxn") <= 0)
    return [
        count_rows(fx, {"fx_parseable_y_positivo": bad}),
        surplus_rows(fx, "fx_llave_unica", ["rate_date", "currency"], null_is_key=True),
    ]


def stock_cells(snapshots: DataFrame) -> DataFrame:
    """Snapshots by day, store and product with their rows, and those whose stock is no valid value."""
    reported = F.col("stock_status") == REPORTED
    bad_stock = (F.col("stock_status") == UNRECOGNISED) | (
        reported & (F.col("stock_qty").isNull() | (F.col("stock_qty") < 0))
    )
    return snapshots.groupBy("snapshot_date", "store_id", "sku_erp").agg(
        F.count("*").alias("n"), F.count_if(bad_stock).alias("bad_stock")
    )


def snapshot_checks(tables: Tables, cells: DataFrame) -> list[DataFrame]:
    absent = (
        cells.where(F.col("sku_erp").isNotNull())
        .select("sku_erp")
        .distinct()
        .join(tables["stg.products"].select("sku_erp"), "sku_erp", "left_anti")
    )
    undated = F.when(F.col("snapshot_date").isNull(), F.col("n"))
    sums = cells.agg(F.coalesce(F.sum("bad_stock"), F.lit(0)).alias("bad_stock"), F.coalesce(F.sum(undated), F.lit(0)).alias("undated"))
    return [
        measure(sums, {"stock_valores_validos": F.col("bad_stock"), "snapshots_parseables": F.col("undated")}),
        *cell_checks(cells),
        _one_row(absent, "snapshots_sku_en_catalogo", F.count("*")),
    ]


def grid_checks(snapshots: DataFrame) -> list[DataFrame]:
    """Repeated cells of the day, store and product grid, and pairs without a row for every day."""
    return cell_checks(snapshots.groupBy("snapshot_date", "store_id", "sku_erp").agg(F.count("*").alias("n")))


def cell_checks(cells: DataFrame) -> list[DataFrame]:
    span = cells.agg(F.min("snapshot_date").alias("lo"), F.max("snapshot_date").alias("hi")).select(
        days_inclusive(F.col("lo"), F.col("hi")).alias("days")
    )
    per_pair = cells.groupBy("store_id", "sku_erp").agg(F.sum("n").alias("rows"))
    return [
        _one_row(cells, "snapshots_llave_unica", F.sum(F.col("n") - 1)),
        count_rows(per_pair, {"snapshots_grilla_completa": F.col("rows") != span.scalar()}),
    ]


def catalogue_checks(tables: Tables, formats: KeyFormats) -> list[DataFrame]:
    products, costs, mappings = tables["stg.products"], tables["stg.cost_history"], tables["stg.sku_mappings"]
    bad_cost = F.col("valid_from").isNull() | F.col("unit_cost_mxn").isNull() | (F.col("unit_cost_mxn") <= 0)
    mapped = with_expected_handle(
        mappings.where(F.col("handle").isNotNull()).withColumnRenamed("sku_pos_num", "sku_num"), products, formats
    )
    return [
        count_rows(products, {"catalogo_sku_formato": F.col("sku_num").isNull()}),
        surplus_rows(products, "catalogo_numero_unico", ["sku_num"], null_is_key=False),
        count_rows(costs, {"costos_parseables_y_positivos": bad_cost}),
        surplus_rows(costs, "costos_sin_fechas_repetidas", ["sku_erp", "valid_from"], null_is_key=True),
        count_rows(
            mappings,
            {
                "mapeo_explicito_mismo_numero": F.col("sku_erp").isNotNull()
                & differs(F.col("sku_pos_num"), F.col("sku_erp_num"))
            },
        ),
        surplus_rows(mappings, "mapeo_sku_pos_unico", ["sku_pos"], null_is_key=False),
        count_rows(
            mapped,
            {
                "mapeo_handle_coincide_con_nombre": differs(F.col("handle_num"), F.col("sku_num"))
                | differs(F.col("handle"), F.col("expected"))
            },
        ),
    ]


def store_checks(tables: Tables, profile: DataFrame, cells: DataFrame) -> list[DataFrame]:
    used = profile.select("store_id").union(cells.select("store_id")).distinct()
    unknown = used.where(F.col("store_id").isNotNull()).join(tables["stg.stores"].select("store_id"), "store_id", "left_anti")
    return [_one_row(unknown, "tiendas_en_erp", F.count("*"))]


def staging_measures(tables: Tables, formats: KeyFormats = KeyFormats()) -> DataFrame:
    """Sales and snapshots are grouped once each, and the groups are stored; most checks read those."""
    groups = settle_all(
        {
            "sales": lambda: pos_profile(tables["stg.pos_sales"]),
            "cells": lambda: stock_cells(tables["stg.inventory_snapshots"]),
            "totals": lambda: tables["raw.source_totals"],
        }
    )
    parts = [
        raw_counts({**tables, "raw.source_totals": groups["totals"]}),
        *pos_checks(tables, groups["sales"]),
        *order_checks(tables, formats),
        *fx_checks(tables),
        *snapshot_checks(tables, groups["cells"]),
        *catalogue_checks(tables, formats),
        *store_checks(tables, groups["sales"], groups["cells"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def fact_profile(sales: DataFrame) -> DataFrame:
    """The fact by channel, document type and currency: all that its checks need, in one pass."""
    return sales.groupBy("channel", "doc_type", "original_currency").agg(
        F.count("*").alias("n"),
        F.sum("original_amount").alias("amount"),
        F.sum("qty").alias("qty"),
        F.sum("revenue_mxn_net").alias("revenue"),
        F.count_if(F.col("product_link_source").isNull()).alias("unlinked"),
        F.count_if((F.col("sales_sign") != 0) & F.col("unit_cost_mxn").isNull()).alias("uncosted"),
        F.count_if(F.col("fx_source") == NO_RATE).alias("unrated"),
    )


def _by(profile: DataFrame, channel: str, column: str, key: str) -> DataFrame:
    return (
        profile.where(F.col("channel") == channel)
        .groupBy(F.col(column).alias(key))
        .agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty"), F.sum("n").alias("n"))
    )


def recalculated_online_sales(raw_orders: DataFrame, raw_fx: DataFrame) -> Column:
    """Converted web sales straight from the raw texts; amounts are added per day before the rate."""
    per_day = raw_orders.groupBy(
        local_timestamp(F.col("fecha")).cast("date").alias("day"), "currency"
    ).agg(F.sum(F.col("amount").cast(MONEY)).alias("amount"))
    rates = raw_fx.select(
        plain_date(F.col("fecha")).alias("day"), "currency", F.col("rate_to_mxn").cast(RATE).alias("rate")
    )
    rate = F.when(F.col("currency") == NATIVE_CURRENCY, F.lit(1).cast(RATE)).otherwise(F.col("rate"))
    return per_day.join(rates, ["day", "currency"], "left").agg(F.sum(F.col("amount") * rate)).scalar()


def beyond(left: Column, right: Column, tolerance: str = AMOUNT_TOLERANCE) -> Column:
    return F.abs(left - right) > F.lit(tolerance).cast("decimal(10,3)")


def sales_checks(tables: Tables) -> list[DataFrame]:
    totals = tables["raw.source_totals"]
    profile = fact_profile(tables["core.fct_sales"])
    physical, online = F.col("channel") == PHYSICAL, F.col("channel") == ONLINE
    summed = profile.agg(
        F.coalesce(F.sum(F.when(physical, F.col("n"))), F.lit(0)).alias("pos_rows"),
        F.sum(F.when(physical, F.col("revenue"))).alias("pos_revenue"),
        F.sum(F.when(online, F.col("revenue"))).alias("web_revenue"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("unlinked", "uncosted", "unrated")],
    )
    zero = F.lit(0)
    net_of_source = F.coalesce(_total(totals, "pos", "amount_by_doc_type", "I"), zero) - F.coalesce(
        _total(totals, "pos", "amount_by_doc_type", "E"), zero
    )
    recalculated = recalculated_online_sales(tables["raw.ecommerce_orders"], tables["raw.fx_rates"])
    by_type = unreconciled(
        _by(profile, PHYSICAL, "doc_type", "doc_type"), totals_by_dimension(totals, "pos", "doc_type"), "doc_type"
    )
    by_currency = unreconciled(
        _by(profile, ONLINE, "original_currency", "currency"),
        totals_by_dimension(totals, "ecommerce", "currency"),
        "currency",
    )
    return [
        measure(
            summed,
            {
                "fct_pos_filas_vs_archivo": F.abs(F.col("pos_rows") - _total(totals, "pos", "rows")),
                "fct_venta_fisica_neta_vs_archivo": beyond(F.coalesce("pos_revenue", zero), net_of_source).cast("int"),
                "fct_ecommerce_mxn_recalculado_desde_raw": beyond(
                    F.coalesce("web_revenue", zero), F.coalesce(recalculated, zero)
                ).cast("int"),
                "fct_producto_vinculado": F.col("unlinked"),
                "fct_costo_vigente_asignado": F.col("uncosted"),
                "fct_fx_asignado": F.col("unrated"),
            },
        ),
        _one_row(by_type, "fct_pos_montos_vs_archivo", F.count("*")),
        _one_row(by_currency, "fct_ecommerce_montos_vs_archivo", F.count("*")),
    ]


def inventory_check(tables: Tables) -> DataFrame:
    """One point each if rows, unknown values or the stock sum differ from the source."""
    totals = tables["raw.source_totals"]
    held = tables["core.fct_inventory_daily"].agg(
        F.count("*").alias("n"),
        F.count_if(F.col("stock_status") == NOT_REPORTED).alias("unknown"),
        F.coalesce(F.sum("stock_qty"), F.lit(0)).alias("stock"),
    )
    points = [
        (F.abs(F.col(c) - _total(totals, "erp", metric)) > 0).cast("int")
        for c, metric in (("n", "snapshots"), ("unknown", "snapshots_na_string"), ("stock", "snapshots_stock_sum"))
    ]
    return measure(held, {"inventario_vs_archivo": reduce(lambda a, b: a + b, points)})


def coverage_checks(tables: Tables) -> DataFrame:
    """Windows against what the sources cover: three rows beside the one row of run windows."""
    params = tables["core.params"]
    p = {c: params.select(c).scalar() for c in ("as_of_date", "rotation_start", "quarter_start", "quarter_end")}
    stock = F.col("source") == INVENTORY
    first, last = F.col("first_date"), F.col("last_date")
    return count_rows(
        tables["core.source_coverage"],
        {
            "inventario_cubre_ventana_rotacion": stock & ((first > p["rotation_start"]) | (last < p["as_of_date"])),
            "inventario_cubre_trimestre": stock & ((first > p["quarter_start"]) | (last < p["quarter_end"])),
            "fuentes_terminan_en_la_misma_fecha": last < p["as_of_date"],
        },
    )


def core_measures(tables: Tables) -> DataFrame:
    parts = [
        *sales_checks(tables),
        inventory_check(tables),
        surplus_rows(tables["core.dim_product"], "dim_producto_numero_unico", ["sku_num"], null_is_key=False),
        coverage_checks(tables),
    ]
    return reduce(DataFrame.unionByName, parts)


def rotation_check(tables: Tables) -> DataFrame:
    """Units of the rotation table against the fact, which shrinks to products before the join."""
    rotation, params = tables["mart.q1_rotation_by_sku"], tables["core.params"]
    start, end = params.select("rotation_start").scalar(), params.select("as_of_date").scalar()
    in_fact = (
        tables["core.fct_sales"]
        .where((F.col("channel") == PHYSICAL) & F.col("sale_date").between(start, end))
        .groupBy("sku_num")
        .agg(F.sum("qty_net").alias("units"))
        .join(rotation.select("sku_num"), "sku_num", "left_semi")
        .agg(F.coalesce(F.sum("units"), F.lit(0)))
        .scalar()
    )
    units = rotation.agg(
        F.coalesce(F.sum(F.col("units_net_tracked") + F.col("units_net_untracked_pairs")), F.lit(0)).alias("units")
    )
    return measure(units, {"q1_unidades_cuadran_con_fct": (F.col("units") != in_fact).cast("int")})


def growth_check(tables: Tables) -> DataFrame:
    params = tables["core.params"]
    first, last = params.select("growth_first_month").scalar(), params.select("growth_last_month").scalar()
    published = (
        tables["mart.q3_monthly_variants"]
        .where(F.col("variant") == PRINCIPAL)
        .groupBy("channel")
        .agg(F.sum("sales_mxn").alias("published"))
    )
    in_fact = (
        tables["core.fct_sales"]
        .where((F.col("sale_date") >= first) & (F.col("sale_date") < F.add_months(last, 1)))
        .groupBy("channel")
        .agg(F.round(F.sum("revenue_mxn_net"), 2).alias("fact"))
    )
    return count_rows(
        published.join(in_fact, "channel"),
        {"q3_meses_cuadran_con_fct": beyond(F.col("published"), F.col("fact"), MONTHS_TOLERANCE)},
    )


def margin_check(tables: Tables) -> DataFrame:
    in_fact = tables["core.fct_sales"].agg(F.sum("margin_mxn_net")).scalar()
    published = tables["mart.q4_margin_by_product_store"].agg(
        F.sum("margin_mxn").alias("margin"), F.count("*").alias("n")
    )
    apart = F.abs(F.col("margin") - in_fact) > F.lit(MARGIN_TOLERANCE).cast("decimal(10,3)") * F.col("n")
    return measure(published, {"q4_margen_cuadra_con_fct": apart.cast("int")})


def privacy_checks(tables: Tables) -> list[DataFrame]:
    outside = {n: t for n, t in tables.items() if not n.startswith(("raw.", "audit."))}
    hits = personal_values(outside)
    return [
        _one_row(hits, "pii_valores_fuera_de_raw", F.sum("hits")),
        measure(fixed_table(hits.sparkSession, [(len(personal_columns(outside)),)], "v"), {"pii_columnas_fuera_de_raw": F.col("v")}),
    ]


def marts_measures(tables: Tables) -> DataFrame:
    parts = [rotation_check(tables), growth_check(tables), margin_check(tables), *privacy_checks(tables)]
    return reduce(DataFrame.unionByName, parts)


MEASURES = {STAGING: staging_measures, CORE: core_measures, MARTS: marts_measures}
