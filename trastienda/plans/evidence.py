"""Numeric evidence for each assumption, as a long table (code, metric, value, label).

A list (stores, products, cities) is one row per item, so that no list has to fit
into a cell or a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trastienda.functions.amounts import percent, ratio
from trastienda.functions.dates import month_of
from trastienda.functions.stats import exact_median
from trastienda.operators.lookup import lookup
from trastienda.plans import growth, margin, stockouts
from trastienda.plans.core import CAPPED_RATE, FROM_ERP, INFERRED, ONLINE, PHYSICAL
from trastienda.plans.staging import NOT_REPORTED

Tables = dict[str, DataFrame]
INCOME, RETURN = "I", "E"


def numbers(code: str, one_row: DataFrame) -> DataFrame:
    """Each column of a one-row table as a metric."""
    rows = [
        F.struct(
            F.lit(code).alias("code"),
            F.lit(c).alias("metric"),
            F.col(c).cast("double").alias("value"),
            F.lit(None).cast("string").alias("label"),
        )
        for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*rows)))


def items(code: str, metric: str, frame: DataFrame, label: Column, value: Column | None = None) -> DataFrame:
    """Each row of a table as one labelled metric row."""
    return frame.select(
        F.lit(code).alias("code"),
        F.lit(metric).alias("metric"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
        label.cast("string").alias("label"),
    )


def shared_top(tables: Tables, code: str, variant: str) -> DataFrame:
    summary = tables["mart.q1_variant_summary"].where(F.col("variant") == variant)
    return items(code, "top_shared_with_principal", summary, F.col("variant"), F.col("skus_shared_with_principal"))


def growth_gap(tables: Tables, code: str, variant: str, channel: str) -> DataFrame:
    """The largest distance of a series from the principal one of its channel."""
    months = tables["mart.q3_monthly_variants"].where(
        (F.col("channel") == channel) & F.col("variant").isin(variant, growth.PRINCIPAL)
    )
    growth_of = lambda v: F.max(F.when(F.col("variant") == v, F.col("mom_growth_pct")))
    gap = months.groupBy("month").agg(F.abs(growth_of(variant) - growth_of(growth.PRINCIPAL)).alias("gap"))
    largest = gap.agg(F.coalesce(F.max("gap"), F.lit(0.0)).alias("gap"))
    return items(code, "largest_growth_gap", largest, F.lit(variant), F.col("gap"))


def windows(tables: Tables) -> DataFrame:
    coverage, params = tables["core.source_coverage"], tables["core.params"]
    dates = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("label"))
        for c in params.columns
        if c != "last_month_complete"
    ]
    parts = [
        items("A01", "first_date", coverage, F.concat_ws(" ", "source", "first_date")),
        items("A01", "last_date", coverage, F.concat_ws(" ", "source", "last_date")),
        params.select(F.inline(F.array(*dates))).select(
            F.lit("A01").alias("code"), "metric", F.lit(None).cast("double").alias("value"), "label"
        ),
        items("A16", "first_online_date", coverage.where(F.col("source") == ONLINE), F.col("first_date")),
    ]
    return reduce(DataFrame.unionByName, parts)


def documents(tables: Tables) -> DataFrame:
    per_type = (
        tables["core.fct_sales"]
        .where(F.col("channel") == PHYSICAL)
        .groupBy("doc_type")
        .agg(F.count("*").alias("n"), F.sum("original_amount").alias("amount"))
    )

    def amount_of(doc_type: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("doc_type") == doc_type, F.col("amount"))), F.lit(0))

    sums = per_type.agg(
        (amount_of(INCOME) - amount_of(RETURN)).alias("net_amount"), F.sum("amount").alias("amount_of_all_types")
    )
    sums = sums.withColumn(
        "all_types_over_net_pct",
        percent(F.col("amount_of_all_types") - F.col("net_amount"), F.col("net_amount"), 6),
    )
    parts = [
        items("A02", "rows", per_type, F.col("doc_type"), F.col("n")),
        items("A02", "amount", per_type, F.col("doc_type"), F.col("amount")),
        numbers("A02", sums),
        growth_gap(tables, "A02", growth.ALL_TYPES, PHYSICAL),
        growth_gap(tables, "A02", growth.INCOME_ONLY, PHYSICAL),
    ]
    return reduce(DataFrame.unionByName, parts)


def returns_matching(sales: DataFrame) -> DataFrame:
    """Returns, and how many follow a sale of the same store, product, quantity and amount.

    Only the earliest sale of each combination matters, so sales shrink to one
    row per combination before they meet the returns.
    """
    keys = ["store_id", "sku_num", "qty", "original_amount"]
    physical = sales.where(F.col("channel") == PHYSICAL)
    first_sale = (
        physical.where(F.col("doc_type") == INCOME).groupBy(*keys).agg(F.min("sale_ts").alias("first_sale_ts"))
    )
    returned = physical.where(F.col("doc_type") == RETURN).select("source_id", "sale_ts", *keys)
    matched = lookup(returned, first_sale, keys).where(F.col("first_sale_ts") <= F.col("sale_ts"))
    return matched.agg(F.count_distinct("source_id").alias("returns_matching_sale")).select(
        returned.agg(F.count("*")).scalar().alias("returns"), "returns_matching_sale"
    )


def unknown_stock(tables: Tables) -> DataFrame:
    held = tables["core.fct_inventory_daily"].agg(
        F.count_if(F.col("stock_status") == NOT_REPORTED).alias("unknown_snapshots"),
        F.count("*").alias("snapshots"),
    )
    share = held.withColumn("unknown_pct", percent(F.col("unknown_snapshots"), F.col("snapshots"), 6))
    return numbers("A04", share).unionByName(shared_top(tables, "A04", "na_como_cero"))


def stockout_stores(tables: Tables) -> DataFrame:
    stores = tables["mart.q2_stores_with_stockouts"]
    counts = stores.agg(
        F.count_if(F.col("status") == stockouts.CONFIRMED).alias("stores_confirmed"),
        F.count_if(F.col("status") == stockouts.POSSIBLE).alias("stores_possible"),
    )
    listed = stores.where(F.col("status").isin(stockouts.CONFIRMED, stockouts.POSSIBLE))
    return numbers("A05", counts).unionByName(
        listed.select(
            F.lit("A05").alias("code"),
            F.col("status").alias("metric"),
            F.lit(None).cast("double").alias("value"),
            F.col("store_id").alias("label"),
        )
    )


def tracked_share(sales: DataFrame, inventory: DataFrame, start: Column, end: Column) -> DataFrame:
    """Pairs with stock records, pairs sold, and the share of sales lines outside the tracked pairs.

    Both sides shrink to their pairs first and meet in one full join.
    """
    pair = ["store_id", "sku_num"]
    tracked = inventory.select(*pair).distinct().withColumn("_tracked", F.lit(True))
    sold = (
        sales.where(
            (F.col("channel") == PHYSICAL) & (F.col("sales_sign") != 0) & F.col("sale_date").between(start, end)
        )
        .groupBy(*pair)
        .agg(F.count("*").alias("n"))
    )
    both = tracked.join(sold, pair, "full_outer")
    return both.agg(
        F.count("_tracked").alias("tracked_pairs"),
        F.count("n").alias("sold_pairs"),
        ratio(F.sum(F.when(F.col("_tracked").isNull(), F.col("n")).otherwise(0)), F.sum("n")).alias(
            "untracked_line_share"
        ),
    )


def inferred_links(sales: DataFrame) -> DataFrame:
    """Lines and revenue that rest on an inferred product link, per channel."""
    inferred = F.col("product_link_source") == INFERRED
    pos, web = inferred & (F.col("channel") == PHYSICAL), inferred & (F.col("channel") == ONLINE)
    return sales.agg(
        F.count_if(pos).alias("inferred_store_lines"),
        F.sum(F.when(pos, F.col("revenue_mxn_net"))).alias("inferred_store_revenue"),
        F.count_if(web).alias("inferred_web_orders"),
        F.sum(F.when(web, F.col("revenue_mxn_net"))).alias("inferred_web_revenue"),
    )


def mapping(tables: Tables) -> DataFrame:
    mapped = tables["stg.sku_mappings"].agg(
        F.count("sku_erp").alias("mapped_to_catalogue"), F.count("handle").alias("mapped_to_handle")
    )
    handles = tables["stg.ecommerce_orders"].agg(F.count_distinct("handle").alias("sold_handles"))
    inferred = tables["core.dim_product"].where(F.col("pos_erp_link_source") == INFERRED)
    variants = tables["mart.q4_margin_variants"]
    principal = variants.where(F.col("variant") == margin.PRINCIPAL).select("sku_num", "sku_pos")
    explicit = variants.where(F.col("variant") == margin.EXPLICIT_ONLY).select("sku_num")
    parts = [
        numbers("A07", mapped),
        numbers("A07", handles),
        numbers("A07", inferred_links(tables["core.fct_sales"])),
        items("A07", "inferred_product", inferred, F.col("sku_pos")),
        items("A07", "product_lost_if_explicit_only", principal.join(explicit, "sku_num", "left_anti"), F.col("sku_pos")),
        shared_top(tables, "A07", "solo_mapeo_explicito"),
    ]
    return reduce(DataFrame.unionByName, parts)


def tax(tables: Tables) -> DataFrame:
    variants = tables["mart.q4_margin_variants"].where(F.col("variant").isin(margin.PRINCIPAL, margin.TAX_INCLUDED))
    sums = variants.groupBy("variant").agg(
        F.sum("stores_negative").alias("pairs"), F.sum("product_margin_mxn").alias("margin")
    )
    parts = [
        items("A08", "negative_pairs", sums, F.col("variant"), F.col("pairs")),
        items("A08", "joint_margin", sums, F.col("variant"), F.round("margin", 2)),
        items("A08", "negative_product", variants, F.concat_ws(" ", "variant", "sku_pos")),
    ]
    return reduce(DataFrame.unionByName, parts)


def capped_rates(tables: Tables) -> DataFrame:
    capped = tables["stg.fx_rates"].where(F.col("is_suspected_cap"))
    label = F.concat(F.col("currency"), F.lit("="), F.col("rate_to_mxn").cast("string"))
    per_rate = capped.groupBy(label.alias("rate")).agg(F.count("*").alias("days"))
    is_capped = F.col("fx_source") == CAPPED_RATE
    affected = (
        tables["core.fct_sales"]
        .where(F.col("channel") == ONLINE)
        .agg(
            F.count_if(is_capped).alias("capped_orders"),
            F.coalesce(F.sum(F.when(is_capped, F.col("revenue_mxn_net"))), F.lit(0)).alias("capped_revenue"),
            F.sum("revenue_mxn_net").alias("online_revenue"),
        )
        .withColumn("capped_pct", percent(F.col("capped_revenue"), F.col("online_revenue"), 6))
    )
    return items("A09", "capped_days", per_rate, F.col("rate"), F.col("days")).unionByName(numbers("A09", affected))


def utc_month_shift(sales: DataFrame) -> DataFrame:
    """Web orders, and their sales, that fall into another month if stamps were UTC."""
    moved = (F.col("channel") == ONLINE) & (month_of(F.col("sale_date")) != month_of(F.col("sale_date_if_utc")))
    return sales.where(moved).agg(
        F.count("*").alias("orders_in_another_month"),
        F.coalesce(F.sum("revenue_mxn_net"), F.lit(0)).alias("revenue_in_another_month"),
    )


def personal_data(tables: Tables) -> DataFrame:
    raw = tables["raw.ecommerce_orders"]
    held = raw.agg(F.count("*").alias("orders"), F.count("customer_rfc").alias("orders_with_tax_number"))
    cities = raw.agg(F.count_distinct("shipping_city").alias("distinct_shipping_cities"))
    return numbers("A11", held).unionByName(numbers("A12", cities))


def store_proposals(tables: Tables) -> DataFrame:
    stores = tables["core.dim_store"]
    proposed = stores.agg(
        F.count_if(F.col("region_source") != FROM_ERP).alias("stores_with_region_proposal"),
        F.count_if(F.col("timezone_source") != FROM_ERP).alias("stores_with_timezone_proposal"),
    )
    cities = stores.select("city").distinct()
    return numbers("A13", proposed).unionByName(items("A14", "city", cities, F.col("city")))


def stock_against_sales(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Does stock move with sales: day-to-day correlation, and days sold without a drop."""
    pair = ["store_id", "sku_num"]
    in_order = Window.partitionBy(*pair).orderBy("snapshot_date", "stock_qty")
    followed = (
        inventory.select(*pair, "snapshot_date", "stock_qty")
        .withColumn("before", F.lag("stock_qty").over(in_order))
        .where(F.col("before").isNotNull() & F.col("stock_qty").isNotNull())
    )
    sold = (
        sales.where(F.col("channel") == PHYSICAL)
        .groupBy(*pair, F.col("sale_date").alias("snapshot_date"))
        .agg(F.sum("qty_net").alias("units"))
    )
    joined = followed.join(sold, [*pair, "snapshot_date"], "left")
    had_sale = F.col("units") > 0
    return joined.agg(
        F.corr("stock_qty", "before").alias("stock_autocorrelation"),
        F.corr(F.col("stock_qty") - F.col("before"), F.coalesce("units", F.lit(0))).alias("stock_change_units_correlation"),
        F.count_if(had_sale).alias("days_with_sale"),
        F.count_if(had_sale & (F.col("stock_qty") >= F.col("before"))).alias("days_with_sale_without_drop"),
    )


def volume(tables: Tables) -> DataFrame:
    """Lines per store and day, and the spread of rotation."""
    per_day_store = (
        tables["core.fct_sales"]
        .where(F.col("channel") == PHYSICAL)
        .groupBy("sale_date", "store_id")
        .agg(F.count("*").alias("n"))
    )
    lines = per_day_store.agg(
        ratio(F.sum("n"), F.count_distinct("sale_date") * F.count_distinct("store_id")).alias("lines_per_store_day")
    )
    rotation = tables["mart.q1_rotation_by_sku"]
    spread = rotation.agg(F.min("rotation").alias("rotation_min"), F.max("rotation").alias("rotation_max"))
    median = exact_median(rotation, "days_of_inventory").withColumnRenamed("median", "days_of_inventory_median")
    return reduce(DataFrame.unionByName, [numbers("A18", lines), numbers("A18", spread), numbers("A18", median)])


def assumption_metrics(tables: Tables) -> DataFrame:
    sales, inventory = tables["core.fct_sales"], tables["core.fct_inventory_daily"]
    params = tables["core.params"]
    start, end = params.select("rotation_start").scalar(), params.select("as_of_date").scalar()
    parts = [
        windows(tables),
        documents(tables),
        numbers("A03", returns_matching(sales)),
        shared_top(tables, "A03", "bruto_sin_restar_devoluciones"),
        unknown_stock(tables),
        stockout_stores(tables),
        numbers("A06", tracked_share(sales, inventory, start, end)),
        shared_top(tables, "A06", "numerador_todas_las_tiendas"),
        mapping(tables),
        tax(tables),
        capped_rates(tables),
        numbers("A10", utc_month_shift(sales)),
        growth_gap(tables, "A10", growth.IF_UTC, ONLINE),
        personal_data(tables),
        store_proposals(tables),
        numbers("A17", stock_against_sales(sales, inventory)),
        volume(tables),
    ]
    return reduce(DataFrame.unionByName, parts)
