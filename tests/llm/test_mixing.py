import duckdb
import pytest
from pyspark.sql import functions as F

from trastienda.llm import mixing
from trastienda.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_their_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS FROM '{sf}/{table}.parquet'")
    result = QUERIES[name](spark, sf)
    columns = sorted(result.columns)
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in result.collect()), key=str) == theirs


def words(spark, sizes):
    """Documents of so many words: {source: [sizes]}."""
    rows, n = [], 0
    for source, each in sizes.items():
        for size in each:
            rows.append((n, "w " * size, source))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def by_hand(totals, most=3):
    """Shares by weight; who is above its cap stops there, and the rest is shared anew."""
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, rest = {}, set(names), float(sum(totals.values()))
    while left:
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > most * totals[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * totals[s])
            rest -= target[s]
        left -= over
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": [10] * 10, "b": [10] * 50, "c": [7] * 90, "d": [3], None: [20]},
        {"a": [1], "b": [1000], "c": [5]},
        {None: [5, 5]},
        {"a": [0], "b": [0, 0]},
        {"x": [1, 1, 1], "y": [100] * 40, "z": [0], "é": [2] * 5},
    ],
)
def test_targets(spark, sizes):
    rows = mixing.mix(words(spark, sizes)).select("row.source", "size", "source_size", "target", "copies", "taken", "times").collect()
    goal = by_hand({s: sum(v) for s, v in sizes.items()})
    for source, each in sizes.items():
        mine = [r for r in rows if r.source == source]
        assert sorted(r.size for r in mine) == sorted(each)
        assert all(r.source_size == sum(each) and r.target == pytest.approx(goal[source]) for r in mine)
        assert abs(sum(r.taken for r in mine) - goal[source]) <= max(each) / 2 + 1e-6
        assert all(r.taken == r.copies * r.size <= 3 * r.size and len(r.times) == r.copies for r in mine)
        assert all(0 <= t <= 1 for r in mine for t in r.times)


def test_time_inverts_the_integral_of_the_schedule(spark):
    for k, knots in enumerate(mixing.SCHEDULES):
        total = mixing.integral(knots)
        parts = [i / 200 for i in range(201)]
        frame = spark.createDataFrame([(p,) for p in parts], "p double").select("p", mixing.time_of(F.col("p"), F.lit(k)).alias("t"))
        for p, t in frame.collect():
            done, at = 0.0, 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
                end = min(t, t1)
                if end > t0:
                    done += (end - t0) * (2 * w0 + (w1 - w0) * (end - t0) / (t1 - t0)) / 2
                at = end
            assert done / total == pytest.approx(p, abs=1e-9) and at <= 1


def test_weights_change_over_the_training(spark):
    docs = words(spark, {"a": [10] * 300, "b": [10] * 300, "c": [10] * 300})
    times = mixing.mix(docs).select("row.source", F.explode("times").alias("t"))
    share = {(r.source, r.half): r["count"] for r in times.groupBy("source", F.floor(F.col("t") * 2).alias("half")).count().collect()}
    assert share["a", 0] > share["a", 1] and share["c", 1] > share["c", 0]


def test_odd_rows(odd, nothing, odd_rows):
    assert mixing.mix(odd, carry=["doc_id"]).count() == len(odd_rows)
    mixed = mixing.training_order(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == mixing.mix(odd).agg(F.sum("copies")).first()[0]
    assert mixing.training_order(nothing).count() == 0


def test_reruns_agree(spark, sf):
    first, second = (sorted(map(str, QUERIES["op4_curriculum_mix"](spark, sf).collect())) for _ in range(2))
    assert first == second


def test_query_is_range_sorted_and_has_all_times(spark, sf):
    result = QUERIES["op4_curriculum_mix"](spark, sf)
    parts = [[r.first_time for r in rows] for rows in result.rdd.glom().collect() if rows]
    times = [t for part in parts for t in part]
    taken = [t for t in times if t is not None]
    assert taken == sorted(taken) and times[: len(taken)] == taken
    assert all((r.first_time, r.second_time, r.third_time).count(None) == 3 - r.taken // r.size for r in result.where("size > 0").collect())
