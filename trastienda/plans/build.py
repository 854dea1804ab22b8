"""A full run: raw, then each layer followed by its gate, then evidence, reports and exports."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.functions.keys import KeyFormats
from trastienda.functions.literals import known_values
from trastienda.plans import core, evidence, growth, margin, reports, rotation, staging, stockouts
from trastienda.quality import checks
from trastienda.quality.gate import run_gate
from trastienda.sources import erp, totals
from trastienda.sources.csv_export import export_csv
from trastienda.sources.files import (
    FX_COLUMNS,
    POS_COLUMNS,
    SourceFiles,
    file_manifest,
    malformed_rows,
    malformed_split_rows,
    read_orders,
    read_split_csv,
    read_text_csv,
    require_sources,
    split_records,
)
from trastienda.sources.json_split import as_lines
from trastienda.sources.lake import Lake
from trastienda.sources.settle import dropped_at_end, settle

Tables = dict[str, DataFrame]
RESULTS, EVIDENCE, MALFORMED = "quality_results", "assumption_metrics", "malformed_rows"
MONTH, STOCK_MONTH = "sale_month", "snapshot_month"
WRITERS = 4


def raw_tables(spark: SparkSession, files: SourceFiles) -> Tables:
    """Source tables as they are, and control totals and a manifest taken from the files."""
    pos, fx, export = files.path("pos"), files.path("fx"), files.path("erp")
    read = read_split_csv if files.line_breaks else read_text_csv
    lines = lambda path: split_records(spark, path).select(F.col("record").alias("line")) if files.line_breaks else totals.read_lines(spark, path)
    orders = read_orders(spark, files.path("ecommerce"))
    # parsed once; blocks are unnested from the stored columns
    documents = settle(erp.read_documents(spark, as_lines(spark, export) if files.split_export else export))
    control = (
        totals.pos_totals(lines(pos))
        .unionByName(totals.order_totals(orders))
        .unionByName(totals.fx_totals(lines(fx), ",".join(FX_COLUMNS)))
        .unionByName(totals.erp_totals(documents))
    )
    return {
        "raw.pos_sales": read(spark, pos, POS_COLUMNS),
        "raw.fx_rates": read(spark, fx, FX_COLUMNS),
        "raw.ecommerce_orders": orders,
        "raw.erp_stores": erp.stores(documents),
        "raw.erp_sku_mappings": erp.sku_mappings(documents),
        "raw.erp_products": erp.products(documents),
        "raw.erp_cost_history": erp.cost_history(documents),
        "raw.erp_snapshots": erp.snapshots(documents),
        "raw.erp_metadata": erp.metadata(documents),
        "raw.source_totals": control,
        "raw.source_files": file_manifest(spark, {s: files.path(s) for s in files.names}),
    }


def malformed(spark: SparkSession, files: SourceFiles) -> DataFrame:
    """(source, row): the rows of the CSV sources that have more or fewer fields than their header."""
    find = malformed_split_rows if files.line_breaks else malformed_rows
    rows = [find(spark, files.path(source), columns).select(F.lit(source).alias("source"), "row") for source, columns in (("pos", POS_COLUMNS), ("fx", FX_COLUMNS))]
    return rows[0].unionByName(rows[1])


def staging_tables(spark: SparkSession, t: Tables, formats: KeyFormats = KeyFormats()) -> Tables:
    return {
        "stg.ref_doc_types": staging.ref_doc_types(spark),
        "stg.pos_sales": staging.pos_sales(t["raw.pos_sales"], formats),
        "stg.ecommerce_orders": staging.ecommerce_orders(t["raw.ecommerce_orders"], formats),
        "stg.fx_rates": staging.fx_rates(t["raw.fx_rates"]),
        "stg.stores": staging.stores(t["raw.erp_stores"]),
        "stg.products": staging.products(t["raw.erp_products"], formats),
        "stg.cost_history": staging.cost_history(t["raw.erp_cost_history"]),
        "stg.sku_mappings": staging.sku_mappings(t["raw.erp_sku_mappings"], formats),
        "stg.inventory_snapshots": staging.inventory_snapshots(t["raw.erp_snapshots"]),
    }


class Run:
    """One rebuild of all layers in a draft of a lake. Every layer is stored before the next reads it; readers see all
    of them once the last gate has passed, and the former run until then."""

    def __init__(self, spark: SparkSession, files: SourceFiles, lake: Lake, formats: KeyFormats = KeyFormats()):
        self.spark, self.files, self.lake, self.formats = spark, files, lake, formats
        self.run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.tables: Tables = {}

    def store(self, name: str, frame: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        layer, table = name.split(".")
        self.tables[name] = self.lake.write(layer, table, frame, partition_by)

    def store_all(self, frames: Tables) -> None:
        """Store tables that do not read each other side by side, so that small ones fill idle slots."""
        with ThreadPoolExecutor(WRITERS) as pool:
            for done in [pool.submit(self.store, name, frame) for name, frame in frames.items()]:
                done.result()

    def gate(self, layer: str) -> None:
        measures = checks.MEASURES[layer]
        extra = {"formats": self.formats} if layer == checks.STAGING else {}
        # The privacy checks look at every stored table, not only at those of this run.
        stored = self.lake.tables("stg", "core", "mart") if layer == checks.MARTS else {}
        run_gate(
            measures({**stored, **self.tables}, **extra),
            checks.checks_of(layer),
            layer,
            self.run_id,
            lambda results: self.lake.write("audit", RESULTS, results, append=True),
        )

    def load_raw(self) -> None:
        require_sources(self.spark, self.files)
        raw = raw_tables(self.spark, self.files)
        # One JSON document is unnested by one task; spread its rows before they are stored.
        raw["raw.erp_snapshots"] = raw["raw.erp_snapshots"].hint("rebalance")
        raw[f"audit.{MALFORMED}"] = malformed(self.spark, self.files)
        self.store_all(raw)

    def build_staging(self) -> None:
        self.store_all(staging_tables(self.spark, self.tables, self.formats))

    def build_core(self) -> None:
        t = self.tables
        pos, orders, products = t["stg.pos_sales"], t["stg.ecommerce_orders"], t["stg.products"]
        snapshots = t["stg.inventory_snapshots"]
        self.store_all(
            {
                "core.source_coverage": core.source_coverage(pos, orders, snapshots),
                "core.dim_store": core.dim_store(t["stg.stores"], core.store_proposals(self.spark)),
                "core.dim_product": core.dim_product(products, t["stg.sku_mappings"], pos, orders),
            }
        )
        inventory = core.fct_inventory_daily(snapshots, products)
        self.store(
            "core.fct_inventory_daily", inventory.withColumn(STOCK_MONTH, F.trunc("snapshot_date", "MM")), (STOCK_MONTH,)
        )
        self.store("core.params", core.anchor_params(t["core.source_coverage"]))
        facts = core.fct_sales(
            pos, orders, t["stg.ref_doc_types"], t["stg.fx_rates"], t["core.dim_product"], t["stg.cost_history"], products
        )
        self.store(
            "core.fct_sales", facts.withColumn(MONTH, F.trunc("sale_date", "MM")), partition_by=("channel", MONTH)
        )

    def build_marts(self) -> None:
        t = self.tables
        sales, inventory = t["core.fct_sales"], t["core.fct_inventory_daily"]
        products, stores, coverage = t["core.dim_product"], t["core.dim_store"], t["core.source_coverage"]
        p = known_values(t["core.params"])
        data_end = known_values(coverage.where(F.col("source") == core.INVENTORY).select("last_date"))["last_date"]

        # The month columns are partitions: filters on them leave the other months unread.
        from_month = F.trunc(p["rotation_start"], "MM")
        sold_in_window = sales.where(F.col(MONTH).between(from_month, p["as_of_date"]))
        held_in_window = inventory.where(F.col(STOCK_MONTH).between(from_month, p["as_of_date"]))
        grown_in_window = sales.where(F.col(MONTH) >= F.add_months(p["growth_first_month"], -1))
        self.store_all(
            {
                "mart.q1_rotation_by_sku": rotation.rotation_by_sku(
                    sold_in_window, held_in_window, products, p["rotation_start"], p["as_of_date"]
                ),
                "mart.q2_stockout_runs": stockouts.stockout_runs(
                    inventory, products, p["quarter_start"], p["quarter_end"], data_end
                ),
                "mart.q3_monthly_variants": growth.monthly_variants(
                    grown_in_window, coverage, p["growth_first_month"], p["growth_last_month"], p["last_month_complete"]
                ),
                "mart.q4_margin_by_product_store": margin.margin_by_product_store(sales, products),
            }
        )
        by_store = t["mart.q4_margin_by_product_store"]
        self.store_all(
            {
                "mart.q1_top10_variants": rotation.top_variants(t["mart.q1_rotation_by_sku"]),
                "mart.q2_stores_with_stockouts": stockouts.stores_with_stockouts(t["mart.q2_stockout_runs"], stores),
                "mart.q3_mom_growth": growth.mom_growth(t["mart.q3_monthly_variants"]),
                "mart.q4_margin_variants": margin.margin_variants(by_store, products),
                "mart.q4_negative_margin_by_store": margin.negative_margin_by_store(by_store, stores),
            }
        )
        self.store_all(
            {
                "mart.q1_variant_summary": rotation.variant_summary(t["mart.q1_top10_variants"]),
                "mart.q4_negative_margin_products": margin.negative_margin_products(t["mart.q4_margin_variants"]),
            }
        )

    def export(self, folder: str) -> None:
        """Every mart and audit table as CSV, and the report tables beside them."""
        exported = [n for n in self.tables if n.startswith(("mart.", "audit.")) and n != f"audit.{MALFORMED}"]
        outputs = {f"{folder}/marts/{name.split('.')[1]}": self.tables[name] for name in exported}
        outputs |= {f"{folder}/reports/{name}": report(self.tables) for name, report in reports.REPORTS.items()}
        with ThreadPoolExecutor(WRITERS) as pool:
            for done in [pool.submit(export_csv, frame, path) for path, frame in outputs.items()]:
                done.result()

    def run(self, export_to: str | None = None) -> Tables:
        self.lake = self.lake.draft(f"run{self.run_id}")
        with dropped_at_end():
            self.load_raw()
        self.build_staging()
        self.gate(checks.STAGING)
        self.build_core()
        self.gate(checks.CORE)
        self.build_marts()
        self.gate(checks.MARTS)
        self.tables[f"audit.{RESULTS}"] = self.lake.table("audit", RESULTS)
        self.store(f"audit.{EVIDENCE}", evidence.assumption_metrics(self.tables))
        self.lake.publish()
        if export_to is not None:
            self.export(export_to)
        return self.tables


def run_all(
    spark: SparkSession, source_folder: str, export_to: str | None = None, lake: Lake | None = None
) -> Tables:
    """Rebuild every layer from a folder of source files."""
    return Run(spark, SourceFiles(source_folder), lake or Lake(spark)).run(export_to)
