import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trastienda.llm import packing
from trastienda.llm.registry import QUERIES


def gapless(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def test_query_against_the_tokenizer(spark, sf, documents):
    rows = QUERIES["op3_best_fit_packing"](spark, sf).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = set()
    for doc_id, text, _, _ in documents:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if piece == 0 else start + 1024]
            expected.add((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    least = -(-sum(r.length for r in rows) // 1024)
    assert least <= gapless(rows, 1024) <= least * 1.01 + 1


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "\x00  Straße 🙂🙂", "x" * 3000, " \n" * 2000])
def test_same_ids_as_the_tokenizer(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.Encoder.of("byte_bpe_50k").ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_very_long_runs_of_blanks(blank):
    """tiktoken alone raises on them."""
    text = "a " + blank * 2_000_000 + "b<|endoftext|>"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.Encoder.of("byte_bpe_50k").ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_odd_rows(odd, nothing, odd_rows):
    rows = packing.pack(odd, shard_pieces=2).collect()
    gapless(rows, 1024)
    assert sum(r.piece == 0 for r in rows) == len(odd_rows)
    assert sum(r.length == 1 for r in rows if r.piece == 0) >= 3
    assert packing.pack(nothing).count() == 0


def test_ids_are_kept_on_request(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    (row,) = packing.tokens(docs, with_ids=True).collect()
    assert row.ids == [*packing.Encoder.of("byte_bpe_50k").ids("one two three four").tolist(), 2] and row.length == len(row.ids)


def start(bins_of, sizes, length):
    bins = packing.Bins(np.array([], "int64"), length)
    bins.sizes, bins.items, bins.fill = list(sizes), [list(b) for b in bins_of], [sum(sizes[i] for i in b) for b in bins_of]
    return bins


@pytest.mark.parametrize(
    ("bins_of", "sizes"),
    [
        ([[0], [1, 2], [3]], [5, 3, 3, 2]),  # a move
        ([[0, 1], [2, 3], [4, 5]], [6, 3, 5, 4, 1, 1]),  # moves into different bins
        ([[0, 1], [2, 3], [4]], [5, 3, 7, 2, 3]),  # an exchange, then a move
    ],
)
def test_search_empties_a_bin(bins_of, sizes):
    bins = start(bins_of, sizes, 10)
    bins.search()
    assert sum(1 for b in bins.items if b) == bins.least()
    assert sorted(i for b in bins.items for i in b) == list(range(len(sizes)))


def test_steps_increase_the_squared_fill():
    rng = np.random.default_rng(7)
    for _ in range(30):
        sizes = rng.integers(1, 9, 12).tolist()
        bins = start([[k] for k in range(12)], sizes, 10)
        while True:
            before = sum(f * f for f in bins.fill)
            order = sorted((b for b in range(12) if bins.items[b]), key=lambda b: bins.fill[b])
            if not any(bins.give(a, b) for a in order for b in reversed(order) if a != b and bins.items[a]):
                break
            assert sum(f * f for f in bins.fill) > before
            assert all(f <= 10 and f == sum(sizes[i] for i in items) for f, items in zip(bins.fill, bins.items, strict=True))


def test_shards_are_even(spark):
    pieces = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.col("id") % 1023 + 1).alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
    rows = packing.place(packing.settle(pieces), shard_pieces=500).collect()
    assert len(rows) == 5000
    least = max(-(-sum(r.length for r in rows) // 1024), sum(r.length > 512 for r in rows))
    assert gapless(rows, 1024) <= 1.03 * least


@pytest.mark.parametrize(("low", "high", "bins"), [(9, 9, 73), (100, 100, 820), (400, 500, 4096), (90, 110, 810), (250, 350, 2673)])
def test_a_shard_of_like_pieces(low, high, bins):
    """Whole shards of equal, short and alike pieces; comparing all bins and pairs of pieces took minutes to hours."""
    sizes = np.random.default_rng(1).integers(low, high + 1, packing.SHARD_PIECES)
    where, offset = packing.pack_sizes(sizes)
    fill = np.bincount(where, weights=sizes)
    assert fill.max() <= 1024 and (offset + sizes <= 1024).all() and len(fill) <= bins
    least = packing.Bins(sizes, 1024).least()
    assert least <= len(fill) <= 1.05 * least


def test_the_step_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(200):
        length = 60
        sizes = rng.integers(1, 20, 9).tolist()
        bins = start([list(range(3)), list(range(3, 6)), [6, 7, 8]], sizes, length)
        donor, taker = sorted((0, 1), key=lambda b: bins.fill[b])
        room, before = length - bins.fill[taker], bins.fill[taker]
        take = lambda b, n: [sum(sizes[i] for i in x) for x in combinations(bins.items[b], n)]
        gains = [a - b for n, m in ((1, 0), (2, 0), (1, 1), (2, 1), (1, 2)) for a in take(donor, n) for b in take(taker, m)]
        best = max((g for g in gains if 0 < g <= room), default=0)
        assert bins.give(donor, taker) == (best > 0) and bins.fill[taker] - before == best
        assert all(bins.fill[b] == sum(sizes[i] for i in bins.items[b]) for b in range(3))
        assert sorted(i for b in bins.items for i in b) == list(range(9))


@pytest.mark.parametrize(("sizes", "least"), [([6] * 5, 5), ([4, 4, 4, 4, 4], 3), ([10, 1], 2), ([], 0), ([3] * 7, 3)])
def test_least_number_of_bins(sizes, least):
    assert packing.Bins(np.array(sizes, "int64"), 10).least() == least
