"""Single operators against brute force, with tables that are broadcast and tables that are not."""

import csv
import json
import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from trastienda.functions.stats import exact_median
from trastienda.functions import stats
from trastienda.operators.lookup import lookup
from trastienda.operators.ranking import top_per_group
from trastienda.operators.runs import empty_days, merged, runs_of_months, zero_runs
from trastienda.operators.validity import asof, validity_intervals
from trastienda.plans import core, evidence, staging
from trastienda.sources import erp, files, totals
from trastienda.star.roles import Star

SF = "/root/testdata/sf0.001"


def as_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*(columns or frame.columns)).collect()), key=repr)


def brute_runs(cells):
    """Walk each pair's days; a bridged run may hold unknown days but starts and ends on a zero."""
    found = []
    by_pair = {}
    for pair, day, stock in cells:
        by_pair.setdefault(pair, {})[day] = stock
    for pair, days in by_pair.items():
        for variant, open_values in (("na_rompe_racha", {0}), ("na_entre_ceros_como_cero", {0, None})):
            run = []
            for day in [*sorted(days), None]:
                joined = day is not None and days[day] in open_values and (not run or day - run[-1] == timedelta(1))
                if joined:
                    run.append(day)
                    continue
                zeros = [d for d in run if days[d] == 0]
                if zeros:
                    length = (zeros[-1] - zeros[0]).days + 1
                    found.append((variant, pair, zeros[0], zeros[-1], length, length - len(zeros)))
                run = [day] if day is not None and days[day] in open_values else []
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_zero_runs_equal_a_walk_over_the_days(spark, seed):
    pick = random.Random(seed)
    start = date(2024, 2, 20)
    cells = [
        (f"S{s}", start + timedelta(d), pick.choice([0, 0, 0, None, 3]))
        for s in range(6)
        for d in range(60)
        if pick.random() > 0.05
    ]
    frame = spark.createDataFrame(cells, "store STRING, day DATE, stock INT")
    runs = zero_runs(frame, ["store"], "day", "stock")
    assert as_rows(runs, "variant", "store", "run_start", "run_end", "run_days", "na_days") == brute_runs(cells)


def test_zero_runs_across_months_and_years(spark):
    """Runs that cover whole months, meet at month ends, or are bridged over a month of unknown days."""
    start = date(2023, 11, 1)
    stock = {}
    for d in range(500):
        day = start + timedelta(d)
        stock[day] = None if day.month == 2 else 4 if day in (date(2023, 12, 31), date(2024, 7, 1)) else 0
    cells = [("S", day, q) for day, q in stock.items()]
    cells += [("T", day, None) for day in stock] + [("U", date(2024, 1, 31), 0), ("U", date(2024, 3, 1), 0), ("V", date(2024, 2, 29), 0), ("V", date(2024, 3, 1), 0)]
    runs = zero_runs(spark.createDataFrame(cells, "store STRING, day DATE, stock INT"), ["store"], "day", "stock")
    assert as_rows(runs, "variant", "store", "run_start", "run_end", "run_days", "na_days") == brute_runs(cells)


@pytest.mark.parametrize("seed", range(2))
def test_summaries_of_parts_merge_in_any_order(spark, seed):
    pick = random.Random(seed)
    cells = [(f"S{s}", date(2024, 1, 20) + timedelta(d), pick.choice([0, 0, None, 3])) for s in range(3) for d in range(70)]
    pick.shuffle(cells)
    months = [empty_days(spark.createDataFrame(cells[k::3], "store STRING, day DATE, stock INT"), ["store"], "day", "stock") for k in range(3)]
    whole = merged(merged(months[2].unionByName(months[0]), ["store"]).unionByName(months[1]), ["store"])
    assert as_rows(runs_of_months(whole, ["store"]), "variant", "store", "run_start", "run_end", "run_days", "na_days") == brute_runs(cells)


def test_days_are_shuffled_as_months(spark):
    """Days are summed up before the first exchange; the second one moves stretches of months."""
    frame = spark.range(10).select(
        (F.col("id") % 3).alias("store"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("day"), (F.col("id") % 2).alias("stock")
    )
    plan = zero_runs(frame, ["store"], "day", "stock")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("partial_bit_or") > 0


def test_event_months_are_the_empty_days_of_the_grid(spark):
    star = Star(spark, SF)
    keys = ["store_id", "sku_num"]
    days = empty_days(star.event_grid, keys, "snapshot_date", "stock_qty")
    told = star.event_months.where("zero + unknown > 0")
    assert as_rows(days.select(*told.columns)) == as_rows(told)


def skewed_facts(spark):
    """A third of the rows share one key, some keys are NULL, some match nothing."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 200)
    return spark.range(3000).select("id", key.cast("int").alias("k"))


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def looked_up(spark):
    dim = spark.range(150).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    return lookup(skewed_facts(spark), dim, ["k"])


def test_lookup_means_the_same_shuffled_and_broadcast(spark, no_broadcast):
    shuffled = looked_up(spark)
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
    expected = [(k, i, k * 10 if k is not None and k < 150 else None) for i, k in [tuple(r) for r in skewed_facts(spark).collect()]]
    assert as_rows(shuffled, "k", "id", "v") == sorted(expected, key=repr)


def test_lookup_broadcasts_a_small_table(spark):
    assert "BroadcastHashJoin" in looked_up(spark)._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split(spark, no_broadcast):
    """A third of the rows share a key; at run time their partition is read in several tasks."""
    sizes = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        facts = skewed_facts(spark).repartition(8)
        dim = spark.range(200).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
        joined = lookup(facts, dim, ["k"])
        assert len(joined.collect()) == 3000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def repeated(spark):
    """Sales, and costs whose keys and start days repeat, with an interval that holds no day."""
    sales = [(1, date(2024, 1, d % 28 + 1)) if d % 3 == 0 else (d % 5 if d % 7 else None, date(2024, 2, d % 28 + 1)) for d in range(90)]
    costs = [
        (1, date(2024, 1, 1), date(2024, 1, 20), 1.0), (1, date(2024, 1, 10), date(9999, 12, 31), 2.0), (1, date(2024, 1, 10), date(2024, 1, 9), 9.0),
        (2, date(2024, 2, 5), date(2024, 2, 6), 3.0), (2, date(2024, 2, 6), date(2024, 2, 8), 4.0), (None, date(2024, 1, 1), date(2024, 3, 1), 7.0),
    ]
    expected = []
    for k, d in sales:
        held = [c for key, a, b, c in costs if key == k and k is not None and a <= d <= b]
        expected += [(k, d, c) for c in held or [None]]
    frames = spark.createDataFrame(sales, "k INT, d DATE"), spark.createDataFrame(costs, "k INT, valid_from DATE, valid_to DATE, cost DOUBLE")
    return asof(*frames, "k", "d"), sorted(expected, key=repr)


def test_every_interval_that_holds_the_day_is_a_row(spark):
    found, expected = repeated(spark)
    assert as_rows(found, "k", "d", "cost") == expected


def test_and_so_it_is_without_a_broadcast(spark, no_broadcast):
    found, expected = repeated(spark)
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert as_rows(found, "k", "d", "cost") == expected


def test_a_hot_key_with_many_steps_is_many_small_groups(spark, no_broadcast):
    """A third of the sales and 1,000 steps belong to one product; no cell of it holds many steps or sales."""
    first, days = date(2020, 1, 1).toordinal(), 1000
    sales = [(0 if n % 3 == 0 else n % 40 + 1, first + n * 7 % days) for n in range(9000)]
    steps = [(0, first + n, n) for n in range(days)] + [(k, first + 100 * (k % 3), -k) for k in range(1, 30)]
    sales, dated = [(k, date.fromordinal(d)) for k, d in sales], [(k, date.fromordinal(d), c) for k, d, c in steps]
    facts = spark.createDataFrame([*sales, (0, date(9999, 12, 31)), (0, None), (None, date(2020, 1, 1)), (99, date(2020, 1, 1))], "k INT, d DATE")
    intervals = validity_intervals(spark.createDataFrame(dated, "k INT, valid_from DATE, cost INT"), "k", "valid_from")
    also = spark.createDataFrame([(0, "a"), (0, "b"), (5, "c")], "k INT, name STRING")
    cost = {}
    for k, d in sales:
        cost[k, d] = max(((since, c) for key, since, c in dated if key == k and since <= d), default=(None, None))[1]
    names = {0: "ab", 5: "c"}
    odd = [(0, date(9999, 12, 31), n, days - 1) for n in "ab"] + [(0, None, n, None) for n in "ab"] + [(None, date(2020, 1, 1), None, None), (99, date(2020, 1, 1), None, None)]
    expected = [(k, d, n, cost[k, d]) for k, d in sales for n in names.get(k, [None])] + odd
    found = asof(facts, intervals, "k", "d", also=also)
    assert sorted(as_rows(found, "k", "d", "name", "cost"), key=repr) == sorted(expected, key=repr)
    spread = facts.where("k = 0").groupBy(F.floor(F.unix_date("d") / 32)).count().agg(F.max("count"), F.count("*")).first()
    assert spread[0] <= 120 and spread[1] >= 31
    joined = as_rows(asof(facts, intervals, "k", "d", also=also, cell_days=1), "k", "d", "name", "cost")
    assert sorted(joined, key=repr) == sorted(expected, key=repr)


def test_an_open_interval_and_a_wrong_date_add_no_cells(spark):
    """Sales in the years 1 and 9999 cost two cells, not all that lie between."""
    facts = spark.createDataFrame([(1, date(1, 1, 1)), (1, date(9999, 12, 31)), (1, date(2024, 1, 1))], "k INT, d DATE")
    held = spark.createDataFrame([(1, date(1, 1, 1), date(9999, 12, 31), 7)], "k INT, valid_from DATE, valid_to DATE, cost INT")
    plan = asof(facts, held, "k", "d")
    assert [r.cost for r in plan.collect()] == [7, 7, 7]
    assert "sequence" not in plan._jdf.queryExecution().toString()


def test_large_and_small_cost_tables_give_the_same_facts(spark):
    star = Star(spark, SF)
    small = core.with_product(star.lines, star.dim_product, star.costs, star.products)
    rows = as_rows(small)
    assert len(rows) == star.lines.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = Star(spark, SF)
        assert as_rows(core.with_product(star.lines, star.dim_product, star.costs, star.products)) == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cost_on_the_edges_of_an_interval(spark):
    costs = spark.createDataFrame(
        [("A", date(2024, 1, 1), 1.0), ("A", date(2024, 2, 1), 2.0), ("B", date(2024, 1, 15), 5.0)],
        "sku_erp STRING, valid_from DATE, unit_cost_mxn DOUBLE",
    )
    intervals = validity_intervals(costs, "sku_erp", "valid_from")
    assert as_rows(intervals, "sku_erp", "valid_from", "valid_to") == [
        ("A", date(2024, 1, 1), date(2024, 1, 31)),
        ("A", date(2024, 2, 1), date(9999, 12, 31)),
        ("B", date(2024, 1, 15), date(9999, 12, 31)),
    ]


def test_rate_cap_needs_more_than_three_repeats_of_the_maximum(spark):
    rates = [("X", 5.0)] * 4 + [("X", 4.0)] * 6 + [("Y", 9.0)] * 3
    frame = spark.createDataFrame(rates, "currency STRING, rate_to_mxn DOUBLE")
    flagged = staging.flag_rate_cap(frame).where("is_suspected_cap")
    assert as_rows(flagged, "currency", "rate_to_mxn") == [("X", 5.0)] * 4


def test_top_per_group_breaks_ties_and_prunes_before_the_shuffle(spark):
    frame = spark.createDataFrame(
        [("a", 3, 1.0), ("a", 1, 1.0 + 1e-15), ("a", 2, 2.0), ("b", 9, None), ("b", 8, 0.5)], "g STRING, k INT, v DOUBLE"
    )
    top = top_per_group(frame, "g", "v", "k", 2)
    assert as_rows(top, "g", "rank", "k") == [("a", 1, 2), ("a", 2, 1), ("b", 1, 8)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [1, 2, 9, 1000, 1001])
@pytest.mark.parametrize("cells", [1, 7, 1000])
def test_exact_median(spark, monkeypatch, size, cells):
    monkeypatch.setattr(stats, "CELLS", cells)
    monkeypatch.setattr(stats, "SKETCH_ACCURACY", 50)
    pick = random.Random(size)
    values = [float(pick.randint(0, 400)) for _ in range(size)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x DOUBLE")
    assert exact_median(frame, "x").first()[0] == statistics.median(values)


def test_returns_match_only_earlier_sales(spark):
    rows = [
        ("fisico", "I", "s1", "S", 1, 2, 10, "2024-01-01"),
        ("fisico", "I", "s2", "S", 1, 2, 10, "2024-03-01"),
        ("fisico", "E", "r1", "S", 1, 2, 10, "2024-02-01"),
        ("fisico", "E", "r2", "S", 1, 3, 10, "2024-02-01"),
        ("fisico", "E", "r3", "S", 1, 2, 10, "2023-12-01"),
        ("ecommerce", "E", "r4", "S", 1, 2, 10, "2024-02-01"),
    ]
    frame = spark.createDataFrame(
        rows, "channel STRING, doc_type STRING, source_id STRING, store_id STRING, sku_num INT, qty INT, original_amount INT, sale_ts STRING"
    )
    assert as_rows(evidence.returns_matching(frame)) == [(3, 1)]


def test_json_lines_and_one_document_give_the_same_tables(spark, tmp_path):
    import small_shop

    export = small_shop.shop()["erp"]
    whole = tmp_path / "inventory.json"
    whole.write_text(json.dumps(export, ensure_ascii=False), encoding="utf-8")
    lines = tmp_path / "inventory.jsonl"
    lines.mkdir()
    parts = [{"tiendas_info": [s]} for s in export["tiendas_info"]]
    parts += [{"sku_mappings": [m]} for m in export["sku_mappings"]]
    parts += [{"catalogo": {"productos": [p]}} for p in export["catalogo"]["productos"]]
    parts += [{"snapshots": export["snapshots"][i : i + 100]} for i in range(0, len(export["snapshots"]), 100)]
    for i in range(3):
        text = "\n".join(json.dumps(p, ensure_ascii=False) for p in parts[i::3])
        (lines / f"part-{i}.jsonl").write_text(text, encoding="utf-8")
    for block in ("stores", "sku_mappings", "products", "cost_history", "snapshots"):
        unnest = getattr(erp, block)
        assert as_rows(unnest(erp.read_documents(spark, str(lines)))) == as_rows(unnest(erp.read_documents(spark, str(whole))))
    of_lines = totals.erp_totals(erp.read_documents(spark, str(lines)))
    assert as_rows(of_lines) == as_rows(totals.erp_totals(erp.read_documents(spark, str(whole))))


def test_json_types_stay_apart(spark, tmp_path):
    values = [5, "5", None, True, 5.5, "N/A", [1], {"a": 1}]
    records = [dict(fecha="2024-01-01", tienda_id=str(i), sku_erp="x", cantidad_en_stock=v) for i, v in enumerate(values)]
    path = tmp_path / "x.json"
    path.write_text(json.dumps({"snapshots": records}))
    unnested = erp.snapshots(erp.read_documents(spark, str(path), "snapshots"))
    kinds = [r[1] for r in as_rows(unnested, "tienda_id", "cantidad_json_type")]
    assert kinds == ["int", "str", "NoneType", "bool", "float", "str", "list", "dict"]
    status = [r[1] for r in as_rows(staging.inventory_snapshots(unnested), "store_id", "stock_status")]
    assert status == ["reportado"] + ["valor_no_reconocido"] * 4 + ["no_reportado"] + ["valor_no_reconocido"] * 2


def test_quoted_csv_fields_reach_both_paths(spark, tmp_path):
    from trastienda.sources.files import POS_COLUMNS, read_text_csv

    path = tmp_path / "sales.csv"
    row = 'V1,2025-01-01 00:00:00,"T ""1"", norte",CN-00001,2,"1.50",MXN,I'
    path.write_text(",".join(POS_COLUMNS) + "\n" + row + "\n", encoding="utf-8")
    assert as_rows(read_text_csv(spark, str(path), POS_COLUMNS), "tienda_id", "monto") == [('T "1", norte', "1.50")]
    value = {(m, d): float(v) for m, d, v in as_rows(totals.pos_totals(totals.read_lines(spark, str(path))), "metric", "dimension", "value")}
    assert value["amount_by_doc_type", "I"] == 1.5 and value["qty_by_doc_type", "I"] == 2


BROKEN_LINES = [
    ("1", "plain", "x"), ("2", 'with "quotes", commas', ""), ("3", "two\nlines", "y"), ("4", 'line\n\n"quoted\n" and, more\n', "z"), ("5", "", "long " * 60 + "\nend"),
    ("6", '"', '""'), ("7", "é\n漢字\n", "t"), ("8", "\n", "\n\n"),
]


@pytest.mark.parametrize("split", [61, 400, 1 << 20])
def test_csv_with_line_breaks_is_read_alike_in_any_split(spark, tmp_path, split):
    for part in range(2):
        with (tmp_path / f"part{part}.csv").open("w", encoding="utf-8", newline="") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(("id", "note", "rest"))
            for k in range(5):
                writer.writerows([(f"{part}-{k}-{i}", note, rest) for i, note, rest in BROKEN_LINES[k % 3 :]])
    columns = ("id", "note", "rest")
    whole = sorted(map(str, files.read_text_csv(spark, str(tmp_path), columns, multi_line=True).collect()))
    with_limits = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}
    for key, value in with_limits.items():
        spark.conf.set(key, value)
    try:
        read = files.read_split_csv(spark, str(tmp_path), columns)
        assert sorted(map(str, read.collect())) == whole and len(whole) == 2 * sum(len(BROKEN_LINES[k % 3 :]) for k in range(5))
        assert files.malformed_split_rows(spark, str(tmp_path), columns).count() == 0
    finally:
        for key in with_limits:
            spark.conf.unset(key)


def test_malformed_records_of_several_lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text('a,b\n1,"x\ny"\n2,"p\nq",3\n"4\n"\n', encoding="utf-8")
    assert [r.row for r in files.malformed_split_rows(spark, str(tmp_path / "in.csv"), ("a", "b")).orderBy("row").collect()] == ['"4\n"', '2,"p\nq",3']


def test_fields_that_only_some_entries_have(spark, tmp_path):
    """Names of any kind and case, nested values, NULL and absent fields."""
    export = {
        "tiendas_info": [{"tienda_id": "1", "Ciudad": "Oaxaca"}, {"tienda_id": "2", "a'b \"c\"": 5, "zona.x": {"k": [1, None]}}, {"tienda_id": "3", "ciudad": "Lerma", "nada": None}],
        "catalogo": {"productos": [{"sku_erp": "p", "peso": 1.50, "cost_history": [{"costo_mxn": 12345678901234567.5, "nota": "n"}, {"costo_mxn": None}]}, {"sku_erp": "q"}]},
    }
    # numbers are kept as they are written
    text = json.dumps(export).replace("1.5,", "1.50,").replace(json.dumps(12345678901234567.5), "12345678901234567.5")
    (tmp_path / "in.json").write_text(text, encoding="utf-8")
    documents = erp.read_documents(spark, str(tmp_path / "in.json"))
    stores = {r.tienda_id: r.asDict() for r in erp.stores(documents).collect()}
    assert {k: v for k, v in stores["2"].items() if v is not None} == {"tienda_id": "2", "a'b \"c\"": "5", "zona.x": '{"k": [1, null]}'}
    assert stores["1"]["ciudad"] == "Oaxaca" and stores["3"]["ciudad"] == "Lerma" and stores["3"]["nada"] is None
    assert [r.asDict() for r in erp.products(documents).orderBy("sku_erp").collect()] == [
        {"sku_erp": "p", "nombre": None, "categoria": None, "peso": "1.50"}, {"sku_erp": "q", "nombre": None, "categoria": None, "peso": None},
    ]
    assert sorted(map(str, [tuple(r) for r in erp.cost_history(documents).collect()])) == sorted(map(str, [("p", None, "12345678901234567.5", None, "n"), ("p", None, None, None, None)]))
    assert {r.metric: int(r.value) for r in totals.erp_totals(documents).collect()}["cost_history"] == 2
    assert erp.sku_mappings(documents).columns == ["sku_pos", "sku_erp", "handle"] and erp.sku_mappings(documents).count() == 0


def test_rate_caps_without_a_window(spark):
    """The flag as a rule over each row's currency, with NULLs and ties, and no window in the plan."""
    rng = random.Random(7)
    rows = [(k, rng.choice(["USD", "EUR", "GBP", None]), rng.choice([None, None, 19.0, 20.0, 20.5, 20.5])) for k in range(60)] + [(100 + k, "JPY", None) for k in range(5)] + [(200, "CAD", None)]
    flagged = staging.flag_rate_cap(spark.createDataFrame(rows, "rate_date int, currency string, rate_to_mxn double"))
    assert "Window" not in flagged._jdf.queryExecution().executedPlan().toString()

    def flag(currency, rate):
        of = [r for _, c, r in rows if c == currency]
        if rate is None:
            return None if of.count(None) > 3 else False
        return rate == max(r for r in of if r is not None) and of.count(rate) > 3

    assert {r.rate_date: r.is_suspected_cap for r in flagged.collect()} == {k: flag(c, r) for k, c, r in rows}
