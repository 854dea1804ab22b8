"""Near duplicates by SimHash, joined with themselves along a binary trie.

A document's fingerprint is 64 bits; two are linked if at most two bits differ. Each
distinct fingerprint counts once. If two differ in at most two bits, then at least one
of the three thirds of their bits is equal. So there are three tries, each with another third
as its first bits, and a pair is followed in each of them from the nodes where that third
ends (a budget of no error before). From there node pairs are traversed together: the
differing bits of a pair of prefixes add up, and a pair beyond the budget is dropped with all
that lies below it. Node pairs with many fingerprints are split by Spark into the pairs of
their children, as often as needed, so that a task only gets small ones; those are
traversed to the end in the task. A task gives a spanning forest of its links, never
all pairs of a group. Components come from repeated rounds of smallest neighbours.

`drop_near_copies` has a contract of its own: word shingles of five, similarity of at least
0.8. Such sets are some ten bits apart, where one trie drops hardly anything early and random fingerprints meet as well. So
its fingerprints have 256 bits, and there is a trie for each rare shingle that similar sets must share, in which node pairs are
traversed together as above (see `rarejoin` and `trie`).

Defined cases: null text and text without words have fingerprint zero and are linked like
any other; repeated rows are in one component; a null doc_id is no component's smallest unless
all are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm import forest, rarejoin
from trastienda.llm.common import WORD, located, text_of
from trastienda.llm.components import components
from trastienda.sources.settle import settle, settle_only

SHINGLE = 3
SEED = 42
BITS = 64
BUDGET = 2
#: Words of a near copy's shingles.
NEAR_SHINGLE = 5
#: A node pair with more fingerprints is split into the pairs of its children.
NODE_ROWS = 2000
#: Rows of small node pairs that a task takes at once, about.
BUCKET_ROWS = 20_000
#: Bits that a split goes down.
STRIDE = 4
#: Shingles hashed at once, which bounds the memory for long texts.
BLOCK = 1 << 16
#: Fingerprints compared at once, left times right.
LEAF = 4096

_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    words = re.findall(WORD, text.translate(_LOWER))
    if not words:
        return 0
    last, digest = max(1, len(words) - size + 1), xxhash.xxh64_intdigest
    ones, count = np.zeros(BITS, "int64"), 0
    for begin in range(0, last, BLOCK):
        end = min(last, begin + BLOCK)
        if last > 1 or len(words) == size:
            shingles = map(" ".join, zip(*(words[begin + k : end + k] for k in range(size)), strict=False))
        else:
            shingles = [" ".join(words)]
        hashes = np.fromiter((digest(x, seed) for x in shingles), "<u8")
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
        count += len(hashes)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, carry: Column, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(key, fp): `carry` and the fingerprint as a signed long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(text.as_py(), size, seed) for text in batch.column(1)), "u8", count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view("i8"))], ["key", "fp"])

    source = docs.select(carry.alias("key"), text_of().alias("text"))
    return source.mapInArrow(scan, f"key {source.schema['key'].dataType.simpleString()}, fp long")


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """The links that join different components, of those in (i, j); `label` names each item's component."""
    found = []
    while len(apart := np.nonzero(label[i] != label[j])[0]):
        i, j = i[apart], j[apart]
        x, y = int(i[0]), int(j[0])
        found.append((x, y))
        low, high = sorted((int(label[x]), int(label[y])))
        label[label == high] = low
    return found


def linked(left: np.ndarray, right: np.ndarray, spent: int, bits: int, budget: int = BUDGET, leaf: int = LEAF) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (left, right) of pairs within the budget: a trie over the lowest `bits` bits of both sorted arrays.

    A frontier holds node pairs of one depth as ranges of the arrays; each level splits
    them by the next bit, adds the bits that differ and drops pairs beyond the budget.
    """
    pairs = [(0, len(left), 0, len(right), spent, bits)]
    while pairs:
        a0, a1, b0, b1, cost, depth = pairs.pop()
        if a0 == a1 or b0 == b1:
            continue
        if depth == 0 or (a1 - a0) * (b1 - b0) <= leaf:
            x, y = left[a0:a1], right[b0:b1]
            i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= budget)
            if len(i):
                yield i + a0, j + b0
            continue
        bit = np.uint64(1 << (depth - 1))
        am, bm = (lo + int(np.searchsorted(side[lo:hi] & bit, bit)) for side, lo, hi in ((left, a0, a1), (right, b0, b1)))
        pairs += [(a0, am, b0, bm, cost, depth - 1), (am, a1, bm, b1, cost, depth - 1)]
        if cost < budget:
            pairs += [(a0, am, bm, b1, cost + 1, depth - 1), (am, a1, b0, bm, cost + 1, depth - 1)]


def _turns(budget: int) -> list[tuple[int, int]]:
    """(turn, bits) of the budget + 1 parts of a fingerprint, one of which is equal within the budget."""
    sizes = [BITS // (budget + 1) + (k < BITS % (budget + 1)) for k in range(budget + 1)]
    return [(sum(sizes[:k]), size) for k, size in enumerate(sizes)]


def _turned(fp: Column, turn: int) -> Column:
    """The fingerprint turned by so many bits, so that another part comes first."""
    return fp if not turn else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, BITS - turn))


def links(distinct: DataFrame, node_rows: int = NODE_ROWS, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` that join all that are within the budget."""
    turns = F.explode(F.array(*[F.struct(F.lit(k).alias("trie"), _turned(F.col("fp"), turn).alias("path"), F.lit(n).alias("depth")) for k, (turn, n) in enumerate(_turns(budget))])).alias("t")
    rows = distinct.select("fp", turns).select("fp", "t.*")
    prefix = lambda path, depth: F.expr(f"shiftrightunsigned({path}, {BITS} - {depth})")
    # side 0 and 1 of a node pair: the same node at first, then pairs of different ones
    open_rows = rows.withColumn("pair", F.concat_ws("-", "trie", prefix("path", "depth"))).select("fp", "path", "depth", "pair", F.lit(2).alias("side"), F.lit(0).alias("spent"))
    done: list[DataFrame] = []
    while True:
        open_rows = settle(open_rows)
        sizes = open_rows.groupBy("pair").agg(F.count("*").alias("rows"), F.min("depth").alias("at"))
        large = settle(sizes.where((F.col("rows") > node_rows) & (F.col("at") < BITS)).select("pair"))
        split = bool(large.take(1))
        small = open_rows.join(large, "pair", "left_anti") if split else open_rows
        done.append(_traverse(small, max(1, open_rows.count() // BUCKET_ROWS), budget, leaf))
        if not split:
            break
        open_rows = _children(open_rows.join(large, "pair", "left_semi"), budget)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _children(rows: DataFrame, budget: int) -> DataFrame:
    """The pairs of children of each node pair, STRIDE bits below, without those beyond the budget."""
    names = range(1 << STRIDE)
    deeper = F.least(F.col("depth") + STRIDE, F.lit(BITS))
    child = F.expr(f"shiftrightunsigned(path, {BITS} - least(depth + {STRIDE}, {BITS})) & ((1 << (least(depth + {STRIDE}, {BITS}) - depth)) - 1)")
    near = [[F.struct(F.lit(other).cast("long").alias("other"), F.lit((own ^ other).bit_count()).alias("more")) for other in names if (own ^ other).bit_count() <= budget] for own in names]
    table = F.array(*[F.array(*x) for x in near])
    met = rows.withColumns({"child": child, "deeper": deeper}).withColumn("near", F.explode(F.element_at(table, (F.col("child") + 1).cast("int"))))
    met = met.where(F.col("spent") + F.col("near.more") <= budget)
    own, other = F.col("child"), F.col("near.other")
    # a node with itself gives each pair of different children once; two nodes give both orders
    left = F.when(F.col("side") == 2, F.least(own, other)).when(F.col("side") == 0, own).otherwise(other)
    right = F.when(F.col("side") == 2, F.greatest(own, other)).when(F.col("side") == 0, other).otherwise(own)
    side = F.when(F.col("side") != 2, F.col("side")).when(own == other, 2).when(own < other, 0).otherwise(1)
    return met.select("fp", "path", F.col("deeper").alias("depth"), F.concat_ws("-", "pair", left, right).alias("pair"), side.alias("side"), (F.col("spent") + F.col("near.more")).alias("spent"))


def _traverse(rows: DataFrame, buckets: int, budget: int, leaf: int) -> DataFrame:
    """The links of small node pairs, which a hash deals into buckets of bounded size."""

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        pair = pd.factorize(frame["pair"])[0]
        path, fp = frame["path"].to_numpy().view("u8"), frame["fp"].to_numpy()
        order = np.lexsort((path, pair))
        pair, path, fp = pair[order], path[order], fp[order]
        side, depth, spent = (frame[c].to_numpy()[order] for c in ("side", "depth", "spent"))
        edge = np.flatnonzero(np.diff(pair, prepend=-1, append=-1))
        found = []
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if hi - lo < 2:
                continue
            lefts, rights = lo + np.flatnonzero(side[lo:hi] != 1), lo + np.flatnonzero(side[lo:hi] != 0)
            label = np.arange(hi - lo)
            for i, j in linked(path[lefts], path[rights], int(spent[lo]), BITS - int(depth[lo]), budget, leaf):
                found += [(fp[lo + a], fp[lo + b]) for a, b in joined(label, lefts[i] - lo, rights[j] - lo)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    bucket = F.pmod(F.xxhash64("pair"), F.lit(buckets).cast("long"))
    return rows.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(scan, "a long, b long")


def near_duplicates(docs: DataFrame, carry: Column | None = None, size: int = SHINGLE, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per document: key (`carry`, or the doc_id), fingerprint (16 hex digits), component (the smallest key)."""
    prints = settle(fingerprints(docs, F.col("doc_id") if carry is None else carry, size))
    distinct = settle(prints.groupBy("fp").agg(F.min("key").alias("least")))
    labels = components(links(distinct.select("fp"), node_rows))
    # the smallest key of each component; fingerprints without links are components of their own
    member = settle(distinct.join(labels.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = member.groupBy("root").agg(F.min("least").alias("component"))
    member = member.join(least, "root").select("fp", "component")
    return prints.join(member, "fp").select("key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component")


def shingles(text: str, size: int = NEAR_SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles; fewer words, or none, are one shingle."""
    found = forest.shingles(text, size)
    return found if len(found) else np.zeros(1, "u8")


def majority(hashes: np.ndarray, words: int = rarejoin.FP_WORDS) -> np.ndarray:
    """The fingerprint of a set of hashes: words of 64 bits, each by another mix of the hashes."""
    found = np.zeros(words, "u8")
    for k, (turn, times) in enumerate(zip(*forest.seeds(words), strict=True)):
        ones = np.zeros(BITS, "int64")
        for begin in range(0, len(hashes), BLOCK):
            part = (hashes[begin : begin + BLOCK] ^ turn) * times
            part = (part ^ part >> np.uint64(32)) * times
            ones += np.unpackbits((part ^ part >> np.uint64(29)).astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
        found[k] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return found


def near_prints(rows: DataFrame, carry: Column) -> DataFrame:
    """(key, n, high, low, fp, rare): of each text's set its size, digest, fingerprint and the shingles it is posted under."""
    counts = rows.sparkSession.sparkContext.broadcast(rarejoin.slot_counts(rows, shingles))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text.as_py()) for text in batch.column(1)]
            digest = np.array([divmod(xxhash.xxh3_128_intdigest(x.tobytes()), 1 << 64) for x in found], "u8").reshape(-1, 2).view("i8")
            fp = [majority(x).view("i8") for x in found]
            rare = [rarejoin.rarest(x, counts.value).view("i8") for x in found]
            columns = [pa.array([len(x) for x in found], pa.int64()), *(pa.array(c) for c in digest.T.copy()), *(pa.array(x, pa.list_(pa.int64())) for x in (fp, rare))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", "n", "high", "low", "fp", "rare"])

    source = rows.select(carry.alias("key"), "text")
    return source.mapInArrow(scan, f"key {source.schema['key'].dataType.simpleString()}, n long, high long, low long, fp array<long>, rare array<long>")


def near_sets(texts: DataFrame) -> DataFrame:
    """(g, shingles) of (g, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([shingles(text.as_py()).view("i8")], pa.list_(pa.int64()))], ["g", "shingles"])

    return texts.select("g", "text").mapInArrow(scan, "g long, shingles array<long>")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component of near copies: that with the smallest doc_id, then place (null ids last)."""
    rows = located(docs, [F.struct("*").alias("row"), F.col("doc_id"), text_of().alias("text")])
    return rows.join(settle_only(lambda: near_copies(rows)), "place", "left_anti").select("row.*")


def near_copies(rows: DataFrame) -> DataFrame:
    """(place): the rows (doc_id, text, place) that have a near copy before them."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("place").alias("place"))
    prints = settle(near_prints(rows, order).withColumn("g", F.monotonically_increasing_id()))
    same = prints.groupBy("high", "low").agg(F.min("key").alias("least"), F.count("*").alias("rows"), F.min(F.struct("g", "n", "fp", "key.place")).alias("one"))
    nodes = settle(same.select("high", "low", "least", "rows", "one.*"))
    # one row of each set is posted; the others are told apart by a narrow join
    again = prints.select("g", "high", "low").join(nodes.where("rows > 1").select("high", "low", F.col("g").alias("one")), ["high", "low"]).where("g <> one").select("g")
    posted = prints.select("g", "n", rarejoin.path(F.col("fp")).alias("path"), "rare").join(settle(again), "g", "left_anti")

    def sets_of(wanted: DataFrame) -> DataFrame:
        places = nodes.select("g", "place").join(wanted, "g", "left_semi")
        return near_sets(rows.select("place", "text").join(places, "place"))

    roots = rarejoin.linked(nodes, posted, sets_of)
    member = settle(nodes.join(roots.select(F.col("node").alias("g"), "root"), "g", "left").select("high", "low", "least", "rows", F.coalesce("root", "g").alias("root")))
    # both sides of the joins with hot groups are tables, so that adaptive execution can split those
    first = settle(member.groupBy("root").agg(F.min("least").alias("first"), F.sum("rows").alias("members")).where("members > 1").drop("members"))
    grouped = settle(member.join(first, "root").select("high", "low", "first"))
    return prints.select("key", "high", "low").join(grouped, ["high", "low"]).where(F.col("key") != F.col("first")).select("key.place")
