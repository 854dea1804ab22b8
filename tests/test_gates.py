"""The staging rules against counter-examples: which rows break a rule, and how many violations it then counts."""

import copy

import pytest
from pyspark.sql import functions as F

import small_shop
from trastienda.plans.build import Run, raw_tables, staging_tables
from trastienda.quality import checks
from trastienda.quality.gate import QualityCheckError, evaluate
from trastienda.sources.files import SourceFiles
from trastienda.sources.lake import Lake

#: Where the rows of a source are, and the field that names one of them.
ROWS = {
    "sale": (lambda shop: shop["pos"], "venta_id"),
    "order": (lambda shop: shop["orders"], "order_id"),
    "rate": (lambda shop: shop["fx"], "fecha"),
    "mapping": (lambda shop: shop["erp"]["sku_mappings"], "sku_pos"),
    "product": (lambda shop: shop["erp"]["catalogo"]["productos"], "nombre"),
    "cost": (lambda shop: [c for p in shop["erp"]["catalogo"]["productos"] for c in p["cost_history"]], "proveedor"),
    "stock": (lambda shop: shop["erp"]["snapshots"], None),
}

#: Shops that break several rules at once: the rows changed, and the violations of each rule that isn't kept.
SHOPS = {
    "sales of other kinds": (
        [
            ("sale", "A05", {"tipo_comprobante": "Q"}),
            ("sale", "A04", {"moneda": "JPY"}),
            ("sale", "A06", {"moneda": ""}),
            ("sale", "A03", {"monto": "-20.00"}),
            ("sale", "A13", {"cantidad": "-5"}),
        ],
        {"pos_tipo_comprobante_conocido": 1, "pos_moneda_mxn": 2, "pos_cantidad_y_monto_positivos": 2},
    ),
    "sales that can't be read": (
        [("sale", "A02", {"cantidad": "four"}), ("sale", "A07", {"fecha_hora": "30.12.2023"}), ("sale", "A12", {"monto": "1,000.00"})],
        {"pos_campos_parseables": 3},
    ),
    "keys of sales": (
        [
            ("sale", "A16", {"venta_id": "A15"}),
            ("sale", "A09", {"tienda_id": "L40"}),
            ("sale", "A10", {"sku": "CN-00512"}),
            ("sale", "A11", {"sku": "CN-00512"}),
        ],
        {"pos_venta_id_unico": 1, "tiendas_en_erp": 1, "pos_sku_en_catalogo": 1},
    ),
    "orders": (
        [
            ("order", "W-1", {"currency": "GBP", "amount": 0.0}),
            ("order", "W-3", {"fecha": "2023-11-28 09:00:00"}),
            ("order", "W-4", {"product_handle": "té-verde-polvo-011", "order_id": "W-2"}),
        ],
        {
            "ecommerce_moneda_conocida": 1,
            "ecommerce_cantidad_y_monto_positivos": 1,
            "fx_cobertura": 2,
            "ecommerce_handle_coincide_con_nombre": 1,
            "ecommerce_order_id_unico": 1,
        },
    ),
    "orders that can't be read": ([("order", "W-4", {"fecha": "early"})], {"ecommerce_campos_parseables": 1}),
    "rates": (
        [("rate", "2023-11-19", {"rate_to_mxn": "-20.5"}), ("rate", "2023-11-20", {"rate_to_mxn": "n/a"}), ("rate", "2023-11-18", {"fecha": "2023-11-17"})],
        {"fx_parseable_y_positivo": 2, "fx_llave_unica": 1},
    ),
    "mappings": (
        [("mapping", "CN-00011", {"sku_erp": small_shop.erp(13)}), ("mapping", "CN-00012", {"handle": small_shop.MILL}), ("mapping", "CN-00014", {"sku_pos": "CN-00012"})],
        # the third mapping now joins number 12 with key and handle of number 14
        {"mapeo_explicito_mismo_numero": 2, "mapeo_handle_coincide_con_nombre": 2, "mapeo_sku_pos_unico": 1},
    ),
    "catalogue": (
        [("product", "Jarabe Vainilla", {"sku_erp": "ERP-15"}), ("cost", "Casa G0", {"costo_mxn": 0}), ("cost", "Casa T1", {"fecha_vigencia": "2023-01-01"})],
        # a key without a number isn't a number of its own either
        {"catalogo_sku_formato": 1, "catalogo_numero_unico": 1, "costos_parseables_y_positivos": 1, "costos_sin_fechas_repetidas": 1},
    ),
    "a number listed twice": ([("product", "Jarabe Vainilla", {"sku_erp": "ERP-PROV-MX-013-A"})], {"catalogo_numero_unico": 1}),
    "stock values": (
        [("stock", k, {"cantidad_en_stock": value}) for k, value in enumerate(["agotado", -7, "6", 0.5, None, True, [2]])],
        {"stock_valores_validos": 7},
    ),
    # the second row takes the place of the first; the third is no longer dated; the fourth opens a pair of one day
    "stock keys": (
        [("stock", 1, {"fecha": "2023-12-01"}), ("stock", 300, {"fecha": "spring"}), ("stock", 500, {"sku_erp": "ERP-PROV-MX-061-Q"})],
        {"snapshots_llave_unica": 1, "snapshots_parseables": 1, "snapshots_grilla_completa": 2, "snapshots_sku_en_catalogo": 1},
    ),
}


def violated(spark, data, folder):
    """The rules that staging tables computed straight from the files don't keep, with their violations."""
    raw = raw_tables(spark, SourceFiles(small_shop.deliver(data, folder)))
    outcomes = evaluate(checks.staging_measures({**raw, **staging_tables(spark, raw)}), checks.checks_of(checks.STAGING))
    return {o.check.name: o.violations for o in outcomes if not o.passed}


@pytest.mark.parametrize("name", SHOPS)
def test_counter_examples_are_counted(spark, tmp_path, name):
    changes, expected = SHOPS[name]
    data = copy.deepcopy(small_shop.shop())
    for source, which, fields in changes:
        rows, key = ROWS[source][0](data), ROWS[source][1]
        (rows[which] if key is None else next(r for r in rows if r[key] == which)).update(fields)
    assert violated(spark, data, tmp_path / "in") == expected


def test_every_rule_has_a_counter_example():
    shown = {rule for _, expected in SHOPS.values() for rule in expected} | set(checks.RAW_COUNTS) | {"pos_sku_texto_unico_por_numero"}
    assert shown == {c.name for c in checks.checks_of(checks.STAGING)}


@pytest.mark.parametrize("name", checks.RAW_COUNTS)
def test_lost_raw_rows_are_found(spark, tmp_path, name):
    raw = raw_tables(spark, SourceFiles(small_shop.deliver(small_shop.shop(), tmp_path / "in")))
    table = checks.RAW_COUNTS[name][0]
    counted = checks.raw_counts({**raw, table: raw[table].limit(1)})
    assert {o.check.name for o in evaluate(counted, [c for c in checks.CHECKS if c.name in checks.RAW_COUNTS]) if not o.passed} == {name}


def test_two_codes_of_a_number_are_found(spark, tmp_path):
    raw = raw_tables(spark, SourceFiles(small_shop.deliver(small_shop.shop(), tmp_path / "in")))
    staged = staging_tables(spark, raw)
    staged["stg.pos_sales"] = staged["stg.pos_sales"].withColumn("sku_pos", F.concat("sku_pos", F.lit("-"), F.col("store_id")))
    outcomes = evaluate(checks.staging_measures({**raw, **staged}), checks.checks_of(checks.STAGING))
    assert "pos_sku_texto_unico_por_numero" in {o.check.name for o in outcomes if not o.passed}


def test_nothing_fails_on_the_intact_shop(spark, tmp_path):
    assert violated(spark, small_shop.shop(), tmp_path / "in") == {}


def test_results_are_stored_before_the_run_stops(spark, tmp_path):
    data = small_shop.shop()
    data["pos"][3]["moneda"] = "JPY"
    run = Run(spark, SourceFiles(small_shop.deliver(data, tmp_path / "in")), Lake(spark, str(tmp_path / "lake"), "stop_"))
    with pytest.raises(QualityCheckError) as error:
        run.run()
    assert error.value.names == ["pos_moneda_mxn"]
    stored = run.lake.table("audit", "quality_results")
    assert stored.count() == 36
    assert stored.where("NOT passed").count() == 1
    assert not [n for n in run.tables if n.startswith("core.")]


def test_a_failed_run_leaves_the_former_one_readable(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), "former_")
    good = Run(spark, SourceFiles(small_shop.deliver(small_shop.shop(), tmp_path / "in")), lake)
    good.run()
    seen = {name: sorted(map(str, frame.collect())) for name, frame in lake.tables("core", "mart", "audit").items()}
    assert len(seen["core.fct_sales"]) == 20 and len(seen["audit.quality_results"]) == 54
    data = small_shop.shop()
    data["pos"] = data["pos"][:9]
    data["pos"][2]["moneda"] = "JPY"
    bad = Run(spark, SourceFiles(small_shop.deliver(data, tmp_path / "next")), lake)
    with pytest.raises(QualityCheckError):
        bad.run()
    assert {name: sorted(map(str, frame.collect())) for name, frame in lake.tables("core", "mart", "audit").items()} == seen
    assert bad.lake.table("audit", "quality_results").where("NOT passed").count() == 1
    bad.lake.drop()
    with pytest.raises(ValueError, match="reads this run"):
        good.lake.drop()
    assert lake.table("core", "fct_sales").count() == 20


def test_missing_sources_are_all_named(spark, tmp_path):
    run = Run(spark, SourceFiles(str(tmp_path)), Lake(spark, str(tmp_path / "lake"), "none_"))
    with pytest.raises(FileNotFoundError, match="sales.csv, inventory.json, ecommerce_orders.parquet, exchange_rates.csv"):
        run.load_raw()


def test_a_missing_control_total_fails_unless_told_otherwise(spark, tmp_path):
    raw = raw_tables(spark, SourceFiles(small_shop.deliver(small_shop.shop(), tmp_path / "in")))
    raw["raw.source_totals"] = raw["raw.source_totals"].where("source <> 'fx'")
    counted = checks.raw_counts(raw)
    watched = [c for c in checks.CHECKS if c.name in checks.RAW_COUNTS]
    strict = {o.check.name for o in evaluate(counted, watched) if not o.passed}
    assert strict == {"raw_fx_filas_vs_archivo"}
    assert all(o.passed for o in evaluate(counted, watched, null_passes=True))


def test_a_run_reports_malformed_rows(spark, tmp_path):
    folder = small_shop.deliver(small_shop.shop(), tmp_path / "in")
    with open(f"{folder}/exchange_rates.csv", "a", encoding="utf-8") as out:
        out.write("2023-11-29,EUR\r\n")
    for line_breaks in (False, True):
        run = Run(spark, SourceFiles(folder, line_breaks=line_breaks), Lake(spark, str(tmp_path / f"lake{line_breaks}"), f"bad{line_breaks}_"))
        run.load_raw()
        assert [tuple(r) for r in run.lake.table("audit", "malformed_rows").collect()] == [("fx", "2023-11-29,EUR")]
        assert run.tables["raw.pos_sales"].count() == 16
        totals = {(r.source, r.metric): int(r.value) for r in run.tables["raw.source_totals"].collect()}
        assert totals["pos", "rows"] == 16 and totals["fx", "rows"] == run.tables["raw.fx_rates"].count()
