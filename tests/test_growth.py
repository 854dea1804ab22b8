"""Jobs whose work must not grow faster than their tables."""

import os
import re
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trastienda.operators.validity import asof
from trastienda.plans import core
from trastienda.sources.settle import settle_all, settle_lines
from trastienda.sources.totals import read_lines
from trastienda.star import queries
from trastienda.star.roles import Star

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def files_below(folder):
    return [f"{d}/{f}" for d, _, names in os.walk(folder.removeprefix("file:")) for f in names if f.startswith("part-")]


def test_repeated_costs_meet_as_groups(spark, tmp_path, monkeypatch):
    """Forty parts share a number: their 400 sales of a day count 16,000 rows, but meet as a row per day and kind of interval."""
    keys = [*[1 + 50 * n for n in range(40)], 1, 2, 7, None]
    prices = {2: None}
    parts = [(k, prices.get(k, 10.0 + (k or 0))) for k in keys]
    first = datetime(1996, 12, 31)
    lines = [(k, first + timedelta(n % 3 * 200)) for n in range(1200) for k in (1,)]
    lines += [(2, first), (2, datetime(1990, 1, 1)), (7, first), (None, first), (1, None), (3, first), (51, datetime(2001, 1, 1))]
    spark.createDataFrame(parts, "p_partkey BIGINT, p_retailprice DOUBLE").selectExpr("*", "'x' p_name", "'y' p_type").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, "l_partkey BIGINT, l_shipdate TIMESTAMP_NTZ").selectExpr(
        "*", "1L l_orderkey", "1 l_linenumber", "1L l_suppkey", "1D l_quantity", "1D l_extendedprice", "'N' l_returnflag", "'O' l_linestatus"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")

    starts = [date(1995, 3, 1), date(1997, 7, 15), date(1997, 7, 15), date(2000, 2, 29), date(2000, 2, 29)]
    price_of = dict(parts)
    expected = {}
    for k, stamp in lines:
        number, day = (k % 50 if k is not None and k % 7 else None), stamp and stamp.date()
        held = []
        if number is not None and day is not None:
            for p in set(keys) - {None}:
                if p % 50 == number:
                    times = keys.count(p)
                    # costs are found by code, so a code that comes twice has each step twice, and each of its intervals two products
                    steps = sorted(starts * times)
                    held += [price_of[p]] * sum(times for since, until in zip(steps, [*steps[1:], None]) if since <= day and (until is None or day < until))
        n, costs = expected.get((number, day), (0, 0))
        expected[number, day] = n + max(len(held), 1), costs + sum(c is not None for c in held)

    made = []

    def counted(*args, **more):
        made.append(whole(*args, **more))
        return made[-1]

    whole = queries.asof
    monkeypatch.setattr(queries, "asof", counted)
    found = queries.QUERIES["asof_cost_repeated"](spark, str(tmp_path)).collect()
    assert {(r["sku_num"], r["sale_date"] and date.fromisoformat(r["sale_date"])): (r["n"], r["costs"]) for r in found} == expected
    assert expected[1, first.date()] == (400 * 41, 400 * 41)
    assert made[0].count() == len(found) == len(expected)


def test_deliveries_are_packed(spark):
    """The text of a delivery is several times the table; packed, it is read back line by line."""
    rows = spark.range(20_000).select(F.format_string('{"fecha":"2024-01-%02d","tienda_id":"S%s"}', F.col("id") % 28 + 1, F.col("id") % 50).alias("line"))
    plain, packed = settle_lines(rows, "jsonl"), settle_lines(rows, "jsonl", packed=True)
    assert read_lines(spark, packed).exceptAll(read_lines(spark, plain)).isEmpty() and read_lines(spark, packed).count() == 20_000
    sizes = [sum(map(os.path.getsize, files_below(folder))) for folder in (plain, packed)]
    assert sizes[1] * 5 < sizes[0]
    star = Star(spark, SF)
    for frame in (star.pos_lines, star.documents):
        assert all(name.endswith(".gz") for name in frame.inputFiles())


def shuffles(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(n).getName() for n in range(files.size())) if "shuffle_" in name}


def left_of(spark, before):
    """The shuffle files that are new and stay."""
    until = time.time() + 5
    while shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    return shuffles(spark) - before


def test_shuffles_of_stored_tables_are_deleted(spark):
    before = shuffles(spark)
    made = settle_all({name: lambda k=k: spark.range(1000).groupBy((F.col("id") % k).alias("k")).count() for name, k in (("a", 7), ("b", 11))})
    assert not left_of(spark, before)
    assert {name: frame.count() for name, frame in made.items()} == {"a": 7, "b": 11}


def test_marts_leave_no_shuffles(spark):
    before = shuffles(spark)
    built = Star(spark, SF).built
    assert not left_of(spark, before)
    assert built["mart.q4_margin_by_product_store"].count() > 0


def test_what_evidence_reads_is_packed(spark):
    built = Star(spark, SF).built
    for name in ("core.fct_sales", "core.dim_product", "mart.q1_rotation_by_sku", "mart.q4_margin_by_product_store", "mart.q4_margin_variants"):
        assert all(file.endswith(".zstd.parquet") for file in built[name].inputFiles()), name


def test_cells_of_a_key_are_shuffled_as_bits(spark, no_broadcast):
    """Facts and what is handed to their cells are shuffled by cell, and nothing else: the cells are told by a row per key and block."""
    facts = spark.range(2000).select((F.col("id") % 5).alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    steps = spark.range(5).select(F.col("id").alias("k"), F.lit("2021-01-01").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit(1).alias("cost"))
    for also in (None, spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("name"))):
        plan = asof(facts, steps, "k", "d", also=also)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"hashpartitioning\(.*_cell#", text)) == 1
        assert [tuple(r) for r in plan.groupBy("cost").count().orderBy("cost").collect()] == [(None, 366), (1, 1634)]


def test_cells_before_the_epoch_and_far_off(spark):
    days = [date(1, 1, 1), date(1899, 12, 31), date(1969, 12, 31), date(1970, 1, 1), date(9999, 12, 31)]
    days += [date(1970, 2, 1) + timedelta(n * 31) for n in range(200)]
    facts = spark.createDataFrame([(1, d) for d in days] + [(1, None), (None, days[0])], "k INT, d DATE")
    steps = spark.createDataFrame([(1, d, d, n) for n, d in enumerate(days)], "k INT, valid_from DATE, valid_to DATE, n INT")
    found = {(r.k, r.d): r.n for r in asof(facts, steps, "k", "d").collect()}
    assert found == {**{(1, d): n for n, d in enumerate(days)}, (1, None): None, (None, days[0]): None}


def test_lines_come_out_of_the_cost_join_as_they_went_in(spark):
    """Columns that travel as one, or are worked out again, keep every value and every NULL."""
    star = Star(spark, SF)
    odd = (
        star.lines.limit(40).withColumn("sales_sign", F.lit(None).cast("int")).withColumn("qty_net", F.lit(None).cast("int")).withColumn("revenue_mxn_net", F.lit(None).cast("decimal(24,6)"))
        .unionByName(star.lines.limit(30).withColumn("sale_date", F.lit(None).cast("date")))
        .unionByName(star.lines.limit(20).withColumn("sale_date_if_utc", F.lit(None).cast("date")).withColumn("sku_num", F.lit(None).cast("bigint")))
    )
    lines = star.lines.unionByName(odd).localCheckpoint()
    out = core.with_product(lines, star.dim_product, star.costs, star.products)
    assert dict(out.dtypes).items() >= dict(lines.dtypes).items()
    out = out.select(*lines.columns).localCheckpoint()
    assert lines.exceptAll(out).isEmpty() and out.exceptAll(lines).isEmpty()
