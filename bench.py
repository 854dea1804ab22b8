"""Time the headline queries end to end (plan building included) and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads. Every query computes all of
its rows and columns and throws them away. After the queries, a whole run over generated
deliveries of a year is timed as `full_run`, the second of two.
"""

from __future__ import annotations

import csv
import json
import os
import random
import re
import sys
import tempfile
import time
from datetime import date, timedelta

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow as pa  # noqa: E402
import pyarrow.parquet as pq  # noqa: E402

from trastienda.plans.build import run_all  # noqa: E402
from trastienda.session import build_session  # noqa: E402
from trastienda.sources.files import FX_COLUMNS, POS_COLUMNS  # noqa: E402
from trastienda.star.queries import QUERIES  # noqa: E402

HEADLINE = (
    "monthly_mom",
    "mom_total",
    "fx_conversion",
    "unified_sales",
    "asof_cost",
    "product_links",
    "rotation_by_sku",
    "rotation_overlap",
    "stockout_runs",
    "stockout_stores",
    "margin_by_product_store",
    "margin_variants",
    "pos_typing",
    "erp_snapshots",
    "control_totals",
    "dq_staging",
    "dq_core",
    "pii_scan",
    "returns_matching",
    "stock_autocorr",
)


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def deliveries(folder: str, sales: int = 86_490, orders: int = 9_947, pairs: int = 632) -> str:
    """Four sound deliveries of 2025: so many sales and orders, and a snapshot per pair and day."""
    pick = random.Random(7)
    days = [date(2025, 1, 1) + timedelta(k) for k in range(365)]
    stores, numbers = [f"B{k:02d}" for k in range(20)], range(1, 201)
    key = lambda n: f"ERP-PROV-MX-{n:03d}-A"
    moment = lambda: f"{pick.choice(days)} {pick.randrange(24):02d}:{pick.randrange(60):02d}:00"

    def write(name: str, columns: tuple[str, ...], rows: list[tuple]) -> None:
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
            csv.writer(out).writerows([columns, *rows])

    kinds = ["I"] * 20 + ["E", "P", "N", "T"]
    write(
        "sales.csv",
        POS_COLUMNS,
        [(f"v-{k}", moment(), pick.choice(stores), f"CN-{pick.choice(numbers):05d}", pick.randrange(1, 9), f"{pick.randrange(500, 90000) / 100:.2f}", "MXN", pick.choice(kinds)) for k in range(sales)],
    )
    write("exchange_rates.csv", FX_COLUMNS, [(d, c, f"{18 + pick.random():.4f}") for d in days for c in ("USD", "EUR")])
    web = [
        dict(order_id=f"w-{k}", fecha=moment(), product_handle=f"cosa-{n}-{n:03d}", cantidad=1, amount=pick.randrange(1, 900) / 1, currency=pick.choice(["MXN", "USD", "EUR"]), customer_email=f"p{k}@correo.example", customer_rfc=None, shipping_city="x")
        for k, n in ((k, pick.choice(numbers)) for k in range(orders))
    ]
    pq.write_table(pa.Table.from_pylist(web, pa.schema([(c, {"cantidad": pa.int64(), "amount": pa.float64()}.get(c, pa.string())) for c in web[0]])), f"{folder}/ecommerce_orders.parquet")
    chosen = pick.sample([(s, n) for s in stores for n in numbers], pairs)
    export = dict(
        metadata=dict(generado="2026-01-01", fuente="bench", descripcion="bench"),
        tiendas_info=[dict(tienda_id=s, ciudad=f"Ciudad {s}", region="r", timezone="America/Mexico_City") for s in stores],
        sku_mappings=[dict(sku_pos=f"CN-{n:05d}", sku_erp=key(n), handle=None) for n in numbers if n % 3],
        catalogo=dict(productos=[dict(sku_erp=key(n), nombre=f"Cosa {n}", categoria="c", cost_history=[dict(fecha_vigencia="2024-01-01", costo_mxn=float(n), proveedor="x")]) for n in numbers]),
        snapshots=[dict(fecha=str(d), tienda_id=s, sku_erp=key(n), cantidad_en_stock=pick.choice([0, 5, 9, 20, "N/A"])) for s, n in chosen for d in days],
    )
    with open(f"{folder}/inventory.json", "w", encoding="utf-8") as out:
        json.dump(export, out)
    return folder


def full_run(spark: SparkSession) -> float:
    folder = deliveries(tempfile.mkdtemp(prefix="bench-"))
    for _ in range(2):
        begin = time.perf_counter()
        run_all(spark, folder)
        took = time.perf_counter() - begin
    return round(took, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "trastienda-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "source_coverage", folder)  # start the JVM's workers before the clock
    times = {name: seconds(spark, name, folder) for name in HEADLINE}
    whole = full_run(spark)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "full_run": whole,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
