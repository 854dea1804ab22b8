"""Rows that differ although totals agree, by sketch and in full."""

import random
from collections import Counter

import pytest

from trastienda.operators import row_sketch

SCHEMA = "shop string, sale int, kind string, amount int"


def sides(rng, rows, swaps):
    left = [(rng.choice(["a", "b", None]), k, rng.choice(["I", None]), rng.randrange(1000)) for k in range(rows)]
    right = list(left)
    for _ in range(swaps):
        i, j = rng.sample(range(rows), 2)
        right[i], right[j] = (*right[i][:3], right[j][3]), (*right[j][:3], right[i][3])
    return left, right


def difference(left, right):
    counts = Counter(left)
    counts.subtract(Counter(right))
    return sorted(((*row, n) for row, n in counts.items() if n), key=str)


def found(spark, left, right, cells=row_sketch.CELLS):
    frames = [spark.createDataFrame(side, SCHEMA).repartition(3) for side in (left, right)]
    return sorted((tuple(r) for r in row_sketch.differing_rows(*frames, ["shop", "sale"], ["kind", "amount"], cells).collect()), key=str)


@pytest.mark.parametrize("swaps, cells", [(0, 600), (5, 600), (60, 600), (500, 60)])
def test_swaps_whose_sums_agree(spark, swaps, cells):
    left, right = sides(random.Random(swaps), 900, swaps)
    assert sum(r[3] for r in left) == sum(r[3] for r in right)
    assert found(spark, left, right, cells) == difference(left, right)


def test_small_differences_are_read_off_the_sketch(spark):
    left, right = sides(random.Random(2), 900, 40)
    frames = [spark.createDataFrame(side, SCHEMA) for side in (left, right)]
    keys = lambda cells: row_sketch.peeled(*[row_sketch.sketch(f, ["shop", "sale"], ["kind", "amount"], cells) for f in frames], cells)
    assert len(keys(600)) == len({r[:2] for r in difference(left, right)})
    assert keys(30) is None


def test_repeated_lost_and_null_rows(spark):
    row, other = ("a", 1, None, 5), ("a", 2, "I", None)
    assert found(spark, [row, row], [row]) == [(*row, 1)]
    assert found(spark, [row, row], []) == [(*row, 2)]
    assert found(spark, [], [row, other]) == [(*row, -1), (*other, -1)]
    assert found(spark, [(None, None, None, None)], [(None, None, "I", None)]) == [(None, None, "I", None, -1), (None, None, None, None, 1)]
    assert found(spark, [("a", 1, "x", 5)], [("a", 1, "y", 5)]) == [("a", 1, "x", 5, 1), ("a", 1, "y", 5, -1)]


def test_exchanged_amounts_keep_the_totals(spark, tmp_path):
    """A missing amount is exchanged as missing, equal line numbers are lines of their own, three lines aren't a pair."""
    from trastienda.star.queries import QUERIES

    lines = [(997, 1, "N", None), (997, 2, "N", 5.0), (1994, 1, "A", 1.0), (1994, 1, "R", 2.0), (2991, 1, "N", 1.0), (2991, 2, "N", 2.0), (2991, 2, "A", 3.0), (998, 1, "N", 7.0), (998, 2, "N", 8.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_returnflag string, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = [(*r[:3], None if r[3] is None else float(r[3]), r[4]) for r in QUERIES["reconcile_rows"](spark, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == sorted(
        [(997, 1, "N", None, 1), (997, 1, "N", 5.0, -1), (997, 2, "N", 5.0, 1), (997, 2, "N", None, -1)]
        + [(1994, 1, "A", 1.0, 1), (1994, 1, "A", 2.0, -1), (1994, 1, "R", 2.0, 1), (1994, 1, "R", 1.0, -1)],
        key=str,
    )
    assert sum((r[3] or 0) * r[4] for r in rows) == 0
