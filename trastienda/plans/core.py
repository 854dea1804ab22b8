"""Gold core: coverage, run windows, reconciled dimensions and the two facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.functions.amounts import DERIVED, RATE
from trastienda.functions.dates import month_of, quarter_of
from trastienda.functions.literals import fixed_table
from trastienda.operators.lookup import lookup
from trastienda.operators.validity import asof

# Channels, sources, provenance labels and the native currency.
PHYSICAL, ONLINE, ONLINE_DOC_TYPE = "fisico", "ecommerce", "shopify"
POS, INVENTORY = "pos", "inventario"
NATIVE_CURRENCY = "MXN"
NATIVE, NO_RATE, CAPPED_RATE, DAILY_RATE = "mxn_nativo", "sin_fx", "fx_diario_tope_sospechoso", "fx_diario"
EXPLICIT, INFERRED, NO_POS_SALES, NO_HANDLE = "explicito", "inferido", "sin_ventas_pos", "sin_handle"
FROM_ERP, PROPOSED = "erp", "propuesta_inferida"
# Where the ERP contradicts geography, and the proposed value.
STORE_PROPOSALS = (
    ("Monterrey", "centro", "noreste", None, None),
    ("Chihuahua", "centro", "norte", None, None),
    ("Ciudad Juárez", None, None, "America/Ojinaga", "America/Ciudad_Juarez"),
)
#: Columns of sales lines that have few values.
TERMS = ("channel", "doc_type", "sales_treatment", "sales_sign", "original_currency", "fx_rate", "fx_source")
PROPOSAL_COLUMNS = "city, region_observed, region_proposed, timezone_observed, timezone_proposed"


def source_coverage(pos: DataFrame, orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """First and last day of each source."""
    dated = ((POS, pos, "sale_date"), (ONLINE, orders, "order_date"), (INVENTORY, inventory, "snapshot_date"))
    return reduce(
        DataFrame.unionByName,
        [
            frame.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date")).select(
                F.lit(source).alias("source"), "first_date", "last_date"
            )
            for source, frame, day in dated
        ],
    )


def anchor_params(coverage: DataFrame) -> DataFrame:
    """The run's windows, counted from the last day with data and not from the clock."""
    as_of = F.col("as_of_date")
    quarter_last = F.date_sub(F.add_months(quarter_of(as_of), 3), 1)
    return (
        coverage.agg(F.max("last_date").alias("as_of_date"))
        .withColumn(
            "quarter_end",
            F.when(as_of == quarter_last, as_of).otherwise(F.date_sub(quarter_of(as_of), 1)),
        )
        .select(
            "as_of_date",
            F.date_add(F.add_months(as_of, -6), 1).alias("rotation_start"),
            quarter_of(F.col("quarter_end")).alias("quarter_start"),
            "quarter_end",
            F.add_months(month_of(as_of), -11).alias("growth_first_month"),
            month_of(as_of).alias("growth_last_month"),
            (as_of == F.last_day(as_of)).alias("last_month_complete"),
        )
    )


def store_proposals(spark: SparkSession, rows=STORE_PROPOSALS) -> DataFrame:
    return fixed_table(spark, rows, PROPOSAL_COLUMNS)


def dim_store(stores: DataFrame, proposals: DataFrame) -> DataFrame:
    """Stores with the source value kept and a proposal beside it, marked as such."""
    region = proposals.where(F.col("region_observed").isNotNull()).select(
        "city", F.col("region_observed").alias("region_erp"), "region_proposed"
    )
    zone = proposals.where(F.col("timezone_observed").isNotNull()).select(
        "city", F.col("timezone_observed").alias("timezone_erp"), "timezone_proposed"
    )

    def origin(proposed: str) -> Column:
        return F.when(F.col(proposed).isNull(), FROM_ERP).otherwise(PROPOSED)

    # The proposals are a handful of constant rows.
    with_region = stores.join(F.broadcast(region), ["city", "region_erp"], "left")
    return with_region.join(F.broadcast(zone), ["city", "timezone_erp"], "left").select(
        "store_id",
        "city",
        "region_erp",
        F.coalesce("region_proposed", "region_erp").alias("region"),
        origin("region_proposed").alias("region_source"),
        "timezone_erp",
        F.coalesce("timezone_proposed", "timezone_erp").alias("timezone"),
        origin("timezone_proposed").alias("timezone_source"),
    )


def dim_product(products: DataFrame, mappings: DataFrame, pos: DataFrame, orders: DataFrame) -> DataFrame:
    """The catalogue, linked by product number to the codes of the other systems.

    Sales shrink to their distinct codes before any join, so a product with many
    sales is one row there. A link is explicit where the mapping table states it.
    """
    sold = pos.select("sku_num", "sku_pos").distinct()
    web = orders.select(F.col("handle_num").alias("sku_num"), F.col("handle").alias("web_handle")).distinct()
    mapped_erp = mappings.where(F.col("sku_erp").isNotNull()).select(
        F.col("sku_pos_num").alias("sku_num"), F.col("sku_erp").alias("mapped_erp")
    )
    mapped_handle = mappings.where(F.col("handle").isNotNull()).select(
        F.col("sku_pos_num").alias("sku_num"), F.col("handle").alias("mapped_handle")
    )
    linked = reduce(
        lambda left, right: left.join(right, "sku_num", "left"), [products, sold, mapped_erp, mapped_handle, web]
    )
    return linked.select(
        "sku_num",
        "sku_pos",
        "sku_erp",
        "product_name",
        "category",
        F.coalesce("mapped_handle", "web_handle").alias("handle"),
        F.when(F.col("sku_pos").isNull(), NO_POS_SALES)
        .when(F.col("mapped_erp").isNotNull(), EXPLICIT)
        .otherwise(INFERRED)
        .alias("pos_erp_link_source"),
        F.when(F.col("mapped_handle").isNotNull(), EXPLICIT)
        .when(F.col("web_handle").isNotNull(), INFERRED)
        .otherwise(NO_HANDLE)
        .alias("handle_link_source"),
    )


def classify_documents(pos: DataFrame, doc_types: DataFrame) -> DataFrame:
    """Treatment and sign of every document; an unknown type keeps a NULL sign.

    The catalogue of types is a handful of constant rows.
    """
    catalogue = doc_types.select("doc_type", "sales_treatment", "sales_sign")
    return pos.join(F.broadcast(catalogue), "doc_type", "left")


def physical_lines(pos: DataFrame, doc_types: DataFrame) -> DataFrame:
    return classify_documents(pos, doc_types).select(
        F.lit(PHYSICAL).alias("channel"),
        F.col("sale_id").alias("source_id"),
        "sale_ts",
        "sale_date",
        F.col("sale_date").alias("sale_date_if_utc"),
        "store_id",
        "sku_num",
        "doc_type",
        "sales_treatment",
        "sales_sign",
        "qty",
        (F.col("qty") * F.col("sales_sign")).alias("qty_net"),
        F.col("currency").alias("original_currency"),
        F.col("amount").alias("original_amount"),
        F.lit(1).cast(RATE).alias("fx_rate"),
        F.lit(NATIVE).alias("fx_source"),
        signed(F.col("amount")).alias("revenue_mxn_net"),
    )


def signed(amount: Column) -> Column:
    return (amount * F.col("sales_sign")).cast(DERIVED)


def converted(amount: Column, rate: Column) -> Column:
    return (amount * rate).cast(DERIVED)


def online_lines(orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Web orders in the native currency at the rate of their day, with its provenance."""
    native = F.col("currency") == NATIVE_CURRENCY
    rates = fx.select(
        F.col("rate_date").alias("order_date"), "currency", F.col("rate_to_mxn").alias("_rate"), "is_suspected_cap"
    )
    rate = F.when(native, F.lit(1).cast(RATE)).otherwise(F.col("_rate"))
    return lookup(orders, rates, ["order_date", "currency"]).select(
        F.lit(ONLINE).alias("channel"),
        F.col("order_id").alias("source_id"),
        F.col("order_ts").alias("sale_ts"),
        F.col("order_date").alias("sale_date"),
        F.col("order_date_if_utc").alias("sale_date_if_utc"),
        F.lit(None).cast("string").alias("store_id"),
        F.col("handle_num").alias("sku_num"),
        F.lit(ONLINE_DOC_TYPE).alias("doc_type"),
        F.lit("venta").alias("sales_treatment"),
        F.lit(1).alias("sales_sign"),
        "qty",
        F.col("qty").alias("qty_net"),
        F.col("currency").alias("original_currency"),
        F.col("amount").alias("original_amount"),
        rate.alias("fx_rate"),
        F.when(native, NATIVE)
        .when(F.col("_rate").isNull(), NO_RATE)
        .when(F.col("is_suspected_cap"), CAPPED_RATE)
        .otherwise(DAILY_RATE)
        .alias("fx_source"),
        converted(F.col("amount"), rate).alias("revenue_mxn_net"),
    )


def cost_intervals(cost_history: DataFrame, products: DataFrame) -> DataFrame:
    """Cost intervals under the product number that sales carry."""
    return cost_history.join(products.select("sku_erp", "sku_num"), "sku_erp").select(
        "sku_num", "valid_from", "valid_to", "unit_cost_mxn"
    )


def with_product(lines: DataFrame, dim_product: DataFrame, cost_history: DataFrame, products: DataFrame) -> DataFrame:
    """Add link provenance, the cost valid on the sale day, and the margin.

    Links and costs meet by product and cell of days first, so the lines are joined once. For that join the
    columns of few values travel as one, which packs well, and what follows from other columns is worked out after it.
    """
    links = dim_product.select("sku_num", "pos_erp_link_source", "handle_link_source")
    day = F.coalesce("sale_date", F.lit("1970-01-01").cast("date"))
    terms = F.struct(F.datediff("sale_date_if_utc", day).alias("_utc_days"), *TERMS).alias("_terms")
    carried = lines.select("source_id", "sale_ts", "sale_date", "store_id", "sku_num", "qty", "original_amount", terms)
    costed = asof(carried, cost_intervals(cost_history, products), "sku_num", "sale_date", also=links)
    physical, amount = F.col("channel") == PHYSICAL, F.col("original_amount")
    link = F.when(physical, F.col("pos_erp_link_source")).otherwise(F.col("handle_link_source"))
    net = {
        "sale_date_if_utc": F.date_add(day, F.col("_utc_days")),
        "qty_net": F.col("qty") * F.col("sales_sign"),
        "revenue_mxn_net": F.when(physical, signed(amount)).otherwise(converted(amount, F.col("fx_rate"))),
    }
    cost = F.col("qty_net") * F.col("unit_cost_mxn")
    return costed.select("*", "_terms.*").withColumns(net).select(
        *lines.columns,
        link.alias("product_link_source"),
        "unit_cost_mxn",
        cost.cast(DERIVED).alias("cost_mxn_net"),
        (F.col("revenue_mxn_net") - cost).cast(DERIVED).alias("margin_mxn_net"),
    )


def fct_sales(
    pos: DataFrame,
    orders: DataFrame,
    doc_types: DataFrame,
    fx: DataFrame,
    dim_product: DataFrame,
    cost_history: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Both channels in one fact; every source row is in it, non-sales with sign 0."""
    lines = physical_lines(pos, doc_types).unionByName(online_lines(orders, fx))
    return with_product(lines, dim_product, cost_history, products)


def fct_inventory_daily(snapshots: DataFrame, products: DataFrame) -> DataFrame:
    return lookup(snapshots, products.select("sku_erp", "sku_num"), ["sku_erp"]).select(
        "snapshot_date", "store_id", "sku_num", "sku_erp", "stock_qty", "stock_status"
    )
