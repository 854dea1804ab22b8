"""What each star-schema table stands for in the retail model.

Line items are store sales and stock records, orders are web orders in three currencies,
parts are the catalogue, suppliers the stores. Every role is a projection or aggregation of
the given tables and keeps all of their rows, with two exceptions that are the roles'
point: days without an order above low priority have no exchange rate, and one brand is
missing from the mappings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.functions.amounts import COST, MONEY, RATE
from trastienda.functions.keys import KeyFormats, slug
from trastienda.functions.literals import known_values
from trastienda.operators.runs import day_bit, runs_of_months
from trastienda.operators.validity import validity_intervals
from trastienda.plans import core, growth, margin, rotation, staging, stockouts
from trastienda.sources import erp, json_split, totals
from trastienda.sources.files import FX_COLUMNS
from trastienda.sources.settle import settle_all, settle_lines

# Nations whose region is contradicted, in the layout of the store proposals.
PROPOSALS = (
    ("NATION_3", "EUROPE", "NORTH EUROPE", None, None),
    ("NATION_7", "ASIA", "EAST ASIA", None, None),
    ("NATION_12", None, None, "Zone/AMERICA", "Zone/ASIA"),
    ("NATION_12", None, None, "Zone/ASIA", "Zone/PACIFIC"),
)
# Cost steps of a part: first day and factor on its retail price.
COST_STEPS = (("1995-03-01", "1.00"), ("1997-07-15", "1.50"), ("2000-02-29", "2.25"))
# The keys of this schema are numbers of any length.
STAR_FORMATS = KeyFormats(
    pos=r"^CN-(\d+)$", erp=r"^ERP-(\d+)$", handle=r"^item-(\d+)$", number_type="bigint"
)
_DELIVERED: dict[tuple, str] = {}
# A run on the event grid counts when it is longer than this.
EVENT_RUN_DAYS = 10


@dataclass
class Star:
    """The tables of one folder in their retail roles."""

    spark: SparkSession
    folder: str
    _opened: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """A table by name; its footer is read once."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")
        return self._opened[name]

    def dealt(self, name: str, key: str) -> DataFrame:
        """A table for work that is heavy per row: one that comes as a single piece, and only that, is dealt out."""
        table = self.table(name)
        return table.repartition(self.spark.sparkContext.defaultParallelism, key) if table.rdd.getNumPartitions() == 1 else table

    @cached_property
    def pos(self) -> DataFrame:
        return self.pos_of(self.table("lineitem"))

    @staticmethod
    def pos_of(lineitem: DataFrame) -> DataFrame:
        """Store sales. Flags N and R are sales and returns, A is excluded."""
        flag = F.col("l_returnflag")
        return lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
            F.col("l_shipdate").alias("sale_ts"),
            F.col("l_shipdate").cast("date").alias("sale_date"),
            store_key(F.col("l_suppkey")).alias("store_id"),
            F.concat(F.lit("CN-"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")).alias("sku_pos"),
            F.col("l_partkey").alias("sku_num"),
            F.col("l_quantity").cast("int").alias("qty"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.lit("MXN").alias("currency"),
            F.when(flag == "N", "I")
            .when(flag == "R", "E")
            .when(F.col("l_linestatus") == "F", "P")
            .otherwise("T")
            .alias("doc_type"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        """Web orders: the customer number is the product number, the status the currency."""
        status = F.col("o_orderstatus")
        stamp = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            stamp.alias("order_ts"),
            stamp.cast("date").alias("order_date"),
            staging.if_utc(stamp).alias("order_date_if_utc"),
            F.concat(F.lit("item-"), F.col("o_custkey").cast("string")).alias("handle"),
            F.col("o_custkey").alias("handle_num"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("qty"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            F.when(status == "F", "MXN").when(status == "O", "USD").otherwise("EUR").alias("currency"),
        )

    @cached_property
    def fx(self) -> DataFrame:
        """A rate per day and foreign currency, observed from that day's orders above low priority.

        It is capped at 22, and a day without such an order has no rate.
        """
        observed = (
            self.table("orders")
            .where((F.col("o_orderstatus") != "F") & (F.col("o_orderpriority") != "5-LOW"))
            .groupBy(
                F.col("o_orderdate").cast("date").alias("rate_date"),
                F.when(F.col("o_orderstatus") == "O", "USD").otherwise("EUR").alias("currency"),
            )
            .agg(F.sum(F.col("o_orderkey") % 100).alias("seed"))
        )
        rate = F.lit(18).cast(RATE) + (F.col("seed") % 100).cast(RATE) * F.lit("0.05").cast("decimal(3,2)")
        capped = F.least(F.lit(22).cast(RATE), rate.cast(RATE))
        return staging.flag_rate_cap(observed.select("rate_date", "currency", capped.alias("rate_to_mxn")))

    @cached_property
    def stores(self) -> DataFrame:
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            store_key(F.col("s_suppkey")).alias("store_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region_erp"),
            F.concat(F.lit("Zone/"), "r_name").alias("timezone_erp"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            erp_key(F.col("p_partkey")).alias("sku_erp"),
            F.col("p_partkey").alias("sku_num"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            slug(F.col("p_name")).alias("name_slug"),
        )

    @cached_property
    def mappings(self) -> DataFrame:
        """Brand#7 is missing from the mapping, Brand#13 has no catalogue code, only PROMO has a handle."""
        number = F.col("p_partkey")
        return (
            self.table("part")
            .where(F.col("p_brand") != "Brand#7")
            .select(
                F.concat(F.lit("CN-"), F.lpad(number.cast("string"), 12, "0")).alias("sku_pos"),
                F.when(F.col("p_brand") != "Brand#13", erp_key(number)).alias("sku_erp"),
                F.when(F.col("p_type") == "PROMO", F.concat(F.lit("item-"), number.cast("string"))).alias("handle"),
                number.alias("sku_pos_num"),
                F.when(F.col("p_brand") != "Brand#13", number).alias("sku_erp_num"),
                F.when(F.col("p_type") == "PROMO", number).alias("handle_num"),
            )
        )

    @cached_property
    def costs(self) -> DataFrame:
        """Three cost steps per part, as intervals."""
        steps = F.array(
            *[
                F.struct(
                    F.lit(day).cast("date").alias("valid_from"), F.lit(factor).cast("decimal(4,2)").alias("factor")
                )
                for day, factor in COST_STEPS
            ]
        )
        dated = self.table("part").select(
            erp_key(F.col("p_partkey")).alias("sku_erp"),
            F.col("p_retailprice").cast(COST).alias("price"),
            F.inline(steps),
        )
        priced = dated.select(
            "sku_erp", "valid_from", (F.col("price") * F.col("factor")).cast(COST).alias("unit_cost_mxn")
        )
        return validity_intervals(priced, "sku_erp", "valid_from").select(
            "sku_erp", "valid_from", "valid_to", "unit_cost_mxn"
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock records from the line items. A finished line without discount reports no stock, an open one a text."""
        finished, discounted = F.col("l_linestatus") == "F", F.col("l_discount") > 0
        return self.table("lineitem").select(
            F.col("l_shipdate").cast("date").alias("snapshot_date"),
            store_key(F.col("l_suppkey")).alias("store_id"),
            F.col("l_partkey").alias("sku_num"),
            erp_key(F.col("l_partkey")).alias("sku_erp"),
            F.when(finished & discounted, F.col("l_quantity").cast("int") * 3).alias("stock_qty"),
            F.when(~finished, staging.UNRECOGNISED)
            .when(discounted, staging.REPORTED)
            .otherwise(staging.NOT_REPORTED)
            .alias("stock_status"),
        )

    @cached_property
    def event_grid(self) -> DataFrame:
        """A dense daily grid: events per user and type and day, unknown on some days.

        Events shrink to one row per user, type and day; the calendar is then
        unfolded inside each pair, so the grid costs no join.
        """
        events = self.table("events")
        day = F.col("ts").cast("date")
        bounds = events.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
        per_day = events.groupBy("user_id", "event_type", day.alias("day")).agg(F.count("*").alias("n"))
        per_pair = per_day.groupBy("user_id", "event_type").agg(
            F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("seen")
        )
        unknown = (F.col("user_id") * 7 + F.dayofmonth("snapshot_date")) % 53 == 0
        stock = F.coalesce(F.try_element_at("seen", F.col("snapshot_date")), F.lit(0))
        return (
            per_pair.select("*", F.explode(F.sequence(lo, hi, F.make_dt_interval(days=F.lit(1)))).alias("snapshot_date"))
            .select(
                "snapshot_date",
                F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("store_id"),
                F.col("event_type").alias("sku_num"),
                F.upper("event_type").alias("sku_erp"),
                F.when(~unknown, stock.cast("int")).alias("stock_qty"),
                F.when(unknown, staging.NOT_REPORTED).otherwise(staging.REPORTED).alias("stock_status"),
            )
        )

    @cached_property
    def event_months(self) -> DataFrame:
        """The empty days of `event_grid` as bits of months, told from the days with events: no row per day.

        A user's unknown day is the same in every month, so a month's empty days are its days less that one
        and the days with events.
        """
        events = self.table("events")
        day = F.col("ts").cast("date")
        bounds = events.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
        busy = events.groupBy("user_id", "event_type", F.trunc(day, "MM").alias("month")).agg(F.bit_or(day_bit(day)).alias("bits"))
        pairs = busy.groupBy("user_id", "event_type").agg(F.map_from_entries(F.collect_list(F.struct("month", "bits"))).alias("seen"))
        months = pairs.select("*", F.explode(F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), F.make_ym_interval(months=F.lit(1)))).alias("month"))
        none, silent = F.lit(0).cast("long"), 53 - F.col("user_id") * 7 % 53
        unknown = F.when(silent <= 31, F.call_function("shiftleft", F.lit(1).cast("long"), (silent - 1).cast("int"))).otherwise(none)
        first, last = day_bit(F.greatest("month", lo)), day_bit(F.least(F.last_day("month"), hi))
        inside = last * 2 - first
        return months.select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("store_id"),
            F.col("event_type").alias("sku_num"),
            "month",
            inside.bitwiseAND(F.bitwise_not(F.coalesce(F.try_element_at("seen", F.col("month")), none).bitwiseOR(unknown))).alias("zero"),
            inside.bitwiseAND(unknown).alias("unknown"),
        )

    @cached_property
    def event_products(self) -> DataFrame:
        return self.table("events").select("event_type").distinct().select(
            F.col("event_type").alias("sku_num"),
            F.upper("event_type").alias("sku_erp"),
            F.initcap("event_type").alias("product_name"),
        )

    @cached_property
    def event_stores(self) -> DataFrame:
        """A user's city is the name of the customer with the same number."""
        return self.table("customer").select(
            F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("store_id"),
            F.col("c_name").alias("city"),
        )

    @cached_property
    def event_window(self) -> dict[str, Column]:
        """A two-week window that ends nine days before the last event."""
        last = self.table("events").agg(F.max(F.col("ts").cast("date")).alias("d"))
        window = last.select(
            F.date_sub("d", 22).alias("quarter_start"), F.date_sub("d", 9).alias("quarter_end"), F.col("d").alias("data_end")
        )
        return known_values(window)

    @cached_property
    def doc_types(self) -> DataFrame:
        return staging.ref_doc_types(self.spark)

    @cached_property
    def coverage(self) -> DataFrame:
        return core.source_coverage(self.pos, self.orders, self.inventory)

    @cached_property
    def params(self) -> dict[str, Column]:
        return known_values(core.anchor_params(self.coverage))

    @cached_property
    def dim_product(self) -> DataFrame:
        return core.dim_product(self.products, self.mappings, self.pos, self.orders)

    @cached_property
    def dim_store(self) -> DataFrame:
        return core.dim_store(self.stores, core.store_proposals(self.spark, PROPOSALS))

    @cached_property
    def lines(self) -> DataFrame:
        """Sales lines of both channels before product facts are added."""
        return core.physical_lines(self.pos_of(self.dealt("lineitem", "l_orderkey")), self.doc_types).unionByName(core.online_lines(self.orders, self.fx))

    @cached_property
    def fct_sales(self) -> DataFrame:
        return core.with_product(self.lines, self.dim_product, self.costs, self.products)

    # --- the raw layer ---------------------------------------------------------------------

    @cached_property
    def raw_pos(self) -> DataFrame:
        """Store sales as text; taxed at the top rate they carry a decimal comma no number parser accepts."""
        pos = self.dealt("lineitem", "l_orderkey")
        amount = F.col("l_extendedprice").cast(MONEY).cast("string")
        return pos.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("venta_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("fecha_hora"),
            store_key(F.col("l_suppkey")).alias("tienda_id"),
            F.concat(F.lit("CN-"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")).alias("sku"),
            F.col("l_quantity").cast("int").cast("string").alias("cantidad"),
            F.when(F.col("l_tax") >= 0.08, F.replace(amount, F.lit("."), F.lit(","))).otherwise(amount).alias("monto"),
            F.lit("MXN").alias("moneda"),
            F.when(F.col("l_returnflag") == "N", "I")
            .when(F.col("l_returnflag") == "R", "E")
            .when(F.col("l_linestatus") == "F", "P")
            .otherwise("T")
            .alias("tipo_comprobante"),
        )

    @cached_property
    def raw_orders(self) -> DataFrame:
        """Web orders with a text stamp and the personal columns, which only raw may hold."""
        personal = self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lpad(F.col("o_custkey").cast("string"), 13, "X")).alias(
                "customer_rfc"
            ),
            F.concat(F.lit("City "), F.col("o_custkey").cast("string")).alias("shipping_city"),
            *[F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice", "o_orderpriority")],
        )
        status = F.col("o_orderstatus")
        stamp = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
        return personal.select(
            "order_id",
            F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("fecha"),
            F.concat(F.lit("item-"), F.col("o_custkey").cast("string")).alias("product_handle"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("cantidad"),
            F.col("o_totalprice").alias("amount"),
            F.when(status == "F", "MXN").when(status == "O", "USD").otherwise("EUR").alias("currency"),
            "customer_rfc",
            "shipping_city",
        )

    @cached_property
    def raw_fx(self) -> DataFrame:
        return self.fx.select(
            F.date_format("rate_date", "yyyy-MM-dd").alias("fecha"),
            "currency",
            F.col("rate_to_mxn").cast("string").alias("rate_to_mxn"),
        )

    @cached_property
    def pos_lines(self) -> DataFrame:
        """The text lines of a CSV delivery of the store sales, read back from its files."""
        return self.delivered("pos", self.raw_pos)

    def delivered(self, name: str, raw: DataFrame) -> DataFrame:
        return totals.read_lines(self.spark, self.delivery(name, lambda: raw.select(F.to_csv(F.struct("*"))), "csv", packed=True))

    def delivery(self, name: str, lines: Callable[[], DataFrame], kind: str, packed: bool = False) -> str:
        """The folder of a text delivery, which is written once per session and state of the tables' files."""
        key = (self.spark.sparkContext.applicationId, self.folder, name, self.state)
        if key not in _DELIVERED:
            _DELIVERED[key] = settle_lines(lines(), kind, packed)
        return _DELIVERED[key]

    @cached_property
    def state(self) -> int:
        """A hash of names, sizes and times of the table files as they are now."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.folder)
        return files.agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("state")).first()["state"]

    @cached_property
    def documents(self) -> DataFrame:
        """An inventory export as JSON Lines, one record per line, read back from its files."""
        stock = (
            F.when(F.col("l_linestatus") != "F", F.lit('"open"'))
            .when(F.col("l_discount") > 0, (F.col("l_quantity").cast("int") * 3).cast("string"))
            .otherwise('"N/A"')
        )
        snapshots = self.dealt("lineitem", "l_orderkey").select(
            F.format_string(
                '{"snapshots":[{"fecha":"%s","tienda_id":"%s","sku_erp":"%s","cantidad_en_stock":%s}]}',
                F.date_format("l_shipdate", "yyyy-MM-dd"),
                store_key(F.col("l_suppkey")),
                erp_key(F.col("l_partkey")),
                stock,
            ).alias("line")
        )
        steps = F.array(
            *[
                F.struct(
                    F.lit(day).alias("fecha_vigencia"),
                    (F.col("p_retailprice").cast(COST) * F.lit(factor).cast("decimal(4,2)"))
                    .cast(COST)
                    .cast("string")
                    .alias("costo_mxn"),
                    F.col("p_brand").alias("proveedor"),
                )
                for day, factor in COST_STEPS
            ]
        )
        product = F.struct(
            erp_key(F.col("p_partkey")).alias("sku_erp"),
            F.col("p_name").alias("nombre"),
            F.col("p_type").alias("categoria"),
            steps.alias("cost_history"),
        )
        products = self.table("part").select(
            F.to_json(F.struct(F.struct(F.array(product).alias("productos")).alias("catalogo"))).alias("line")
        )
        stores = self.stores.select(
            F.to_json(
                F.struct(
                    F.array(
                        F.struct(
                            F.col("store_id").alias("tienda_id"),
                            F.col("city").alias("ciudad"),
                            F.col("region_erp").alias("region"),
                            F.col("timezone_erp").alias("timezone"),
                        )
                    ).alias("tiendas_info")
                )
            ).alias("line")
        )
        mappings = self.mappings.select(
            F.to_json(F.struct(F.array(F.struct("sku_pos", "sku_erp", "handle")).alias("sku_mappings"))).alias("line")
        )
        lines = snapshots.union(products).union(stores).union(mappings)
        return erp.read_documents(self.spark, self.delivery("export", lambda: lines, "jsonl", packed=True))

    @cached_property
    def uneven_documents(self) -> DataFrame:
        """A catalogue export in which some entries have fields that the others lack."""
        some = lambda condition, value: F.when(condition, value)
        supplier, part = self.table("supplier"), self.table("part")
        store = F.struct(
            store_key(F.col("s_suppkey")).alias("tienda_id"),
            F.col("s_name").alias("ciudad"),
            some(F.col("s_acctbal") < 0, F.col("s_acctbal").cast(MONEY)).alias("saldo"),
            some(F.col("s_nationkey") < 5, F.struct(F.col("s_nationkey").alias("clave"), F.lit("México, D.F.").alias("sede"))).alias("oficina"),
        )
        cost = F.struct(
            F.lit(COST_STEPS[0][0]).alias("fecha_vigencia"),
            F.col("p_retailprice").cast(COST).cast("string").alias("costo_mxn"),
            some(F.col("p_size") >= 40, F.col("p_brand")).alias("lote del proveedor"),
        )
        product = F.struct(
            erp_key(F.col("p_partkey")).alias("sku_erp"),
            F.col("p_name").alias("nombre"),
            some(F.col("p_size") < 10, F.col("p_size")).alias("medida"),
            some(F.col("p_type") == "ECONOMY", F.lit(True)).alias("económico"),
            F.array(cost).alias("cost_history"),
        )
        block = lambda name, entry: F.to_json(F.struct(F.array(entry).alias(name)))
        lines = supplier.select(block("tiendas_info", store).alias("line")).union(
            part.select(F.to_json(F.struct(F.struct(F.array(product).alias("productos")).alias("catalogo"))))
        )
        return erp.read_documents(self.spark, self.delivery("uneven", lambda: lines, "jsonl"))

    @cached_property
    def split_documents(self) -> DataFrame:
        """The stock records as one JSON document (whose lines break between and inside entries), read in byte ranges."""
        entry = F.format_string(
            '{"fecha": "%s",\n "tienda_id": "S%s", "sku_erp": "ERP-%s",\n "cantidad_en_stock": %s}',
            F.date_format("l_shipdate", "yyyy-MM-dd"),
            "l_suppkey",
            "l_partkey",
            F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int").cast("string")).otherwise(F.lit('"}{ N/A"')),
        )
        entries = self.table("lineitem").select(F.concat(entry, F.lit(",")).alias("line"))
        # each part file is a document of its own: framed by the first and last line of its task
        framed = entries.mapInPandas(_document, "line string")
        return erp.read_documents(self.spark, json_split.as_lines(self.spark, self.delivery("one document", lambda: framed, "json")))

    @cached_property
    def broken_lines(self) -> str:
        """The folder of a CSV delivery in which some quoted fields hold line breaks, quotes and commas."""
        note = F.when(F.col("l_tax") >= 0.04, F.concat("l_returnflag", F.lit('\n"'), "l_linestatus", F.lit('",\n\n'), F.date_format("l_shipdate", "yyyy-MM-dd"))).otherwise(F.col("l_returnflag"))
        quoted = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))
        lines = self.table("lineitem").select(F.concat_ws(",", F.concat_ws("-", "l_orderkey", "l_linenumber"), quoted, F.col("l_quantity").cast("int")).alias("line"))
        return self.delivery("line breaks", lambda: lines, "csv")

    @cached_property
    def source_totals(self) -> DataFrame:
        """Control totals of the deliveries."""
        return (
            totals.pos_totals(self.clean_pos_lines)
            .unionByName(totals.order_totals(self.raw_orders))
            .unionByName(totals.fx_totals(self.delivered("fx", self.raw_fx), ",".join(FX_COLUMNS)))
            .unionByName(totals.erp_totals(self.documents))
        )

    @cached_property
    def clean_pos_lines(self) -> DataFrame:
        """The delivery without the decimal commas, the counterpart of the typed role."""
        monto = F.replace("monto", F.lit(","), F.lit("."))
        return self.delivered("clean pos", self.raw_pos.withColumn("monto", monto))

    # --- all layers by name ------------------------------------------------------------------

    @cached_property
    def staged(self) -> dict[str, DataFrame]:
        """Raw and silver tables under their layer names."""
        return {
            "raw.pos_sales": self.raw_pos,
            "raw.ecommerce_orders": self.raw_orders,
            "raw.fx_rates": self.raw_fx,
            "raw.erp_snapshots": self.inventory,
            "raw.erp_products": self.products,
            "raw.erp_sku_mappings": self.mappings,
            "raw.erp_cost_history": self.costs,
            "raw.erp_stores": self.stores,
            "raw.source_totals": self.source_totals,
            "stg.ref_doc_types": self.doc_types,
            "stg.pos_sales": self.pos,
            "stg.ecommerce_orders": self.orders,
            "stg.fx_rates": self.fx,
            "stg.products": self.products,
            "stg.cost_history": self.costs,
            "stg.sku_mappings": self.mappings,
            "stg.stores": self.stores,
            "stg.inventory_snapshots": self.inventory,
        }

    @cached_property
    def cored(self) -> dict[str, DataFrame]:
        """Staged tables plus core; what has many readers is written once."""
        written = settle_all(
            {
                "raw.source_totals": lambda: self.source_totals,
                "core.fct_sales": lambda: self.fct_sales,
                "core.dim_product": lambda: self.dim_product,
                "core.source_coverage": lambda: self.coverage,
                "core.params": lambda: core.anchor_params(self.coverage),
            }
        )
        return {
            **self.staged,
            "core.dim_store": self.dim_store,
            "core.fct_inventory_daily": self.inventory,
            **written,
        }

    @cached_property
    def built(self) -> dict[str, DataFrame]:
        """All layers; marts that others read are written once."""
        t = self.cored
        p = known_values(t["core.params"])
        facts, products, coverage = t["core.fct_sales"], t["core.dim_product"], t["core.source_coverage"]
        first = settle_all(
            {
                "mart.q1_rotation_by_sku": lambda: rotation.rotation_by_sku(
                    facts, self.inventory, products, p["rotation_start"], p["as_of_date"]
                ),
                "mart.q2_stockout_runs": lambda: self.stockout_runs,
                "mart.q3_monthly_variants": lambda: growth.monthly_variants(
                    facts, coverage, p["growth_first_month"], p["growth_last_month"], p["last_month_complete"]
                ),
                "mart.q4_margin_by_product_store": lambda: margin.margin_by_product_store(facts, products),
            }
        )
        by_store = first["mart.q4_margin_by_product_store"]
        second = settle_all(
            {
                "mart.q1_top10_variants": lambda: rotation.top_variants(first["mart.q1_rotation_by_sku"]),
                "mart.q4_margin_variants": lambda: margin.margin_variants(by_store, products),
            }
        )
        return {
            **t,
            **first,
            **second,
            "mart.q1_variant_summary": rotation.variant_summary(second["mart.q1_top10_variants"]),
            "mart.q2_stores_with_stockouts": stockouts.stores_with_stockouts(
                first["mart.q2_stockout_runs"], self.event_stores, EVENT_RUN_DAYS
            ),
            "mart.q3_mom_growth": growth.mom_growth(first["mart.q3_monthly_variants"]),
            "mart.q4_negative_margin_products": margin.negative_margin_products(second["mart.q4_margin_variants"]),
            "mart.q4_negative_margin_by_store": margin.negative_margin_by_store(by_store, self.dim_store),
        }

    @cached_property
    def stockout_runs(self) -> DataFrame:
        w = self.event_window
        runs = runs_of_months(self.event_months, stockouts.PAIR)
        return stockouts.long_runs(
            runs, self.event_products, w["quarter_start"], w["quarter_end"], w["data_end"], EVENT_RUN_DAYS
        )

    @cached_property
    def stockout_stores(self) -> DataFrame:
        return stockouts.stores_with_stockouts(self.stockout_runs, self.event_stores, EVENT_RUN_DAYS)


def _document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines of a task as the entries of one document."""
    yield pd.DataFrame({"line": ['{"metadata": {"fuente": "x"}, "snapshots": [']})
    yield from batches
    yield pd.DataFrame({"line": ["{}]}"]})


def store_key(number: Column) -> Column:
    return F.concat(F.lit("S"), number.cast("string"))


def erp_key(number: Column) -> Column:
    return F.concat(F.lit("ERP-"), number.cast("string"))
