"""Links between similar sets of shingles: SimHash fingerprints are joined along binary tries, one for each rare shingle.

At a similarity of 0.8 fingerprints are so far apart that one trie over all of them drops hardly any pair of nodes before its leaves,
and its work grows with the square. So the tries begin with a shingle, one that similar sets must share, as those of `simhash.links`
begin with a part of the bits that must be equal.

Shingles have one order for the whole corpus: by the number of shingles in their hash slot, rare ones first.
Two sets with a similarity of 0.8 share at least one of the first n - ceil(0.8 n) + 1 shingles in that order, n being a
set's size. So each set is posted under those only, and nothing similar is lost, whatever the counts are; they
just keep frequent shingles out of the postings. Links come in two rounds, each confirmed on the full sets:

1. neighbouring leaves of the trie under a shingle, for each set the one it meets most often, which joins a group of
   near copies by few comparisons;
2. in each trie that still holds several components, node pairs are traversed together (see `trie`): the bits that differ add up, and
   pairs beyond the budget are dropped. Of the pairs that are left, those of different components whose sizes fit are
   candidates. A pair that shares many shingles is compared under the first one.

Postings are sorted by ranges, so a shingle of any frequency is split evenly. In round two a large trie is dealt into blocks, each
a trie of its own, and the blocks meet in pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm import setjoin, trie
from trastienda.llm.components import components
from trastienda.sources.settle import settle

#: Slots that shingles are counted in; the counts are sent to every task.
SLOT_BITS = 16
PERCENT = 80
#: Fingerprints have so many words of 64 bits, and those of similar sets may differ by so many bits. Two sets of
#: similarity 0.8 differ in 39 of 256 on average with a deviation of 6, very small ones in up to 49; sets of 0.3 in 89, with 8.
FP_WORDS, BUDGET = 4, 76
#: Bits by which neighbours in a trie are found.
PATH_BITS = 32
#: Shingles of a set by which pairs that meet more than once are told.
TOLD = 16


def slot_counts(texts: DataFrame, sets: Callable[[str], np.ndarray]) -> np.ndarray:
    """How many shingles of all texts (text) fall into each slot."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, "i8")
        for batch in batches:
            for text in batch.column(0):
                counts += np.bincount(slots(sets(text.as_py())), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])

    found = texts.select("text").mapInArrow(scan, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << SLOT_BITS, "i8")
    counts[found["slot"].to_numpy("i8")] = found["n"].to_numpy("i8")
    return counts


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype("i8")


def rarest(hashes: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles that a set is posted under, in the order of the corpus."""
    kept = len(hashes) - -(-percent * len(hashes) // 100) + 1
    return hashes[np.lexsort((hashes, counts[slots(hashes)]))[:kept]]


def meetings(nodes: DataFrame, by: str = "n") -> DataFrame:
    """(shingle, n, g, before, before_n): the postings of (g, n, rare) that may share their shingle with others, and the set before in it (-1: none) in the order of `by`."""
    names = ["shingle", "n", "g"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), "i8")
        alone = np.zeros(0, "?")  # whether the held row has no partner so far; the range's first row counts as one that has
        for batch in batches:
            now = np.stack([batch.column(c).to_numpy() for c in names])
            if not now.shape[1]:
                continue
            both = np.concatenate([held[:3], now], axis=1)
            same = both[0, 1:] == both[0, :-1]
            first = not held.shape[1]
            met = np.zeros(both.shape[1], "?")
            met[1:] |= same
            met[:-1] |= same
            if first:
                met[0] = True
            else:
                met[0] |= not alone[0]
            before = np.where(np.concatenate([[False], same]), np.concatenate([[-1], both[2, :-1]]), -1)
            before_n = np.concatenate([[0], both[1, :-1]])
            if not first:
                before[0], before_n[0] = held[3, 0], held[4, 0]
            out = np.flatnonzero(met[:-1])
            yield _postings(both[:, out], before[out], before_n[out])
            held = np.stack([*both[:, -1:], before[-1:], before_n[-1:]])
            alone = ~met[-1:]
        if held.shape[1]:
            yield _postings(held[:3], held[3], held[4])

    posted = nodes.select(F.explode("rare").alias("shingle"), F.col(by).cast("long").alias("by"), F.col("n").cast("long").alias("n"), "g")
    ordered = posted.repartitionByRange("shingle", "by", "g").sortWithinPartitions("shingle", "by", "g").select(*names)
    return ordered.mapInArrow(scan, "shingle long, n long, g long, before long, before_n long")


def _postings(rows: np.ndarray, before: np.ndarray, before_n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*rows, before, before_n)], ["shingle", "n", "g", "before", "before_n"])


def under_shared(rooted: DataFrame, prints: DataFrame) -> DataFrame:
    """The rows (shingle, n, g, root) under shingles of several components, dealt into pairs of blocks; their labels are the fingerprints."""
    mixed = rooted.groupBy("shingle").agg(F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high"), F.sum("n").alias("shingles")).where("low < high")
    blocks = F.greatest(F.ceil(F.col("members") / setjoin.BLOCK), F.ceil(F.col("shingles") / setjoin.BLOCK_SHINGLES))
    several = settle(mixed.select("shingle", blocks.alias("blocks")))
    found = rooted.join(several, "shingle").select("g", "n", "root", F.lit(0).alias("tree"), F.col("shingle").alias("region"), "blocks")
    return setjoin.dealt(found, prints.select("g", F.col("fp").alias("labels")))


def told_apart(near: DataFrame) -> DataFrame:
    """The rows with those of their sets' least shingles, of all that are left, that come before their own.

    Sets that share one of their TOLD least shingles are compared under the first such one only; others under each one they share.
    """
    under = near.groupBy("g").agg(F.slice(F.array_sort(F.collect_set("region")), 1, TOLD).alias("under"))
    return near.join(under, "g").select(*setjoin.ROW, F.concat("labels", F.filter("under", lambda x: x < F.col("region"))).alias("labels"))


class Shared(setjoin.Region):
    """The sets of a pair of blocks under one shingle, with the labels of `under_shared` or `told_apart`."""

    def __init__(self, rows: np.ndarray, labels: list[np.ndarray], percent: int, budget: int) -> None:
        self.percent, self.budget, self.one_block = percent, budget, rows[2, 0] == rows[3, 0]
        self.root, self.g, self.n, self.block = rows[4].copy(), rows[5], rows[6], rows[7]
        self.fp = np.array([x[:FP_WORDS] for x in labels], "i8").view("u8")
        self.begin = np.concatenate([[0], np.cumsum([len(x) - FP_WORDS for x in labels])])
        self.earlier = np.concatenate([x[FP_WORDS:] for x in labels])

    def candidates(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        others = np.flatnonzero(self.root[i + 1 :] != self.root[i]) + i + 1
        if not self.one_block:
            others = others[self.block[others] != self.block[i]]
        n = self.n[others]
        others = others[100 * np.minimum(n, self.n[i]) >= self.percent * np.maximum(n, self.n[i])]
        apart = np.bitwise_count(self.fp[others] ^ self.fp[i]).sum(axis=1, dtype="i8")
        near = apart <= self.budget
        others, apart = others[near], apart[near]
        own = self.earlier[self.begin[i] : self.begin[i + 1]]
        if len(own) and len(others):  # pairs that share an earlier shingle meet there
            size = self.begin[others + 1] - self.begin[others]
            edge = np.concatenate([[0], np.cumsum(size)])
            values = self.earlier[np.arange(edge[-1]) + np.repeat(self.begin[others] - edge[:-1], size)]
            hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
            here = np.bincount(np.repeat(np.arange(len(others)), size), hit, len(others)) == 0
            others, apart = others[here], apart[here]
        return others, 64 * FP_WORDS - apart


def whole_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of sorted batches as tables of whole pairs of blocks."""
    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = (pa.concat_tables([held, now]) if held is not None else now).combine_chunks()
        key = np.stack([now.column(c).to_numpy() for c in setjoin.KEY])
        edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        done = int(edge[-1]) if len(edge) else 0
        if done:
            yield now.slice(0, done).combine_chunks()
        held = now.slice(done)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def surviving(table: pa.Table, percent: int, budget: int, leaf: int = trie.LEAF) -> np.ndarray:
    """Which rows are a candidate of another row of their pair of blocks: the tries of the blocks are traversed together, those of all pairs of blocks at once."""
    rows = np.stack([table.column(c).to_numpy() for c in setjoin.ROW])
    lists = table.column("labels").combine_chunks()
    flat, length = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy()
    begin = np.cumsum(length) - length
    fp = flat[begin[:, None] + np.arange(FP_WORDS)].view("u8")
    at = np.arange(FP_WORDS, FP_WORDS + TOLD)
    told = at < length[:, None]
    earlier = flat[np.minimum(begin[:, None] + at, len(flat) - 1)]
    new = np.concatenate([[True], (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)])
    order = trie.order(fp, np.cumsum(new), rows[7])
    low, high, root, n, block = (rows[k, order] for k in (2, 3, 4, 6, 7))
    fp, told, earlier = fp[order], told[order], earlier[order]

    def wanted(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (root[i] != root[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))

    found = np.zeros(rows.shape[1], "?")
    for i, j in trie.linked(fp, *_tries(new, low == high, block), budget, wanted, leaf):
        met = ((earlier[i][:, :, None] == earlier[j][:, None, :]) & told[i][:, :, None] & told[j][:, None, :]).any(axis=(1, 2))
        found[order[i[~met]]] = found[order[j[~met]]] = True
    return found


def _tries(new: np.ndarray, one_block: np.ndarray, block: np.ndarray) -> tuple[trie.Pairs, trie.Pairs]:
    """The (begin, end) of the left and of the right trie of each pair of blocks: one block meets itself, two meet each other."""
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(new))
    start = np.flatnonzero(new | np.concatenate([[True], block[1:] != block[:-1]]))
    second = start[np.minimum(np.searchsorted(start, first, "right"), len(start) - 1)]
    middle = np.where(one_block[first], end, np.where(second > first, np.minimum(second, end), end))
    return (first, middle), (np.where(one_block[first], first, middle), end)


def across(rows: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, budget: int) -> DataFrame:
    """(a, b): links between different components under one shingle, confirmed on the full sets."""

    def shared(table: pa.Table) -> Shared:
        lists = table.column("labels").combine_chunks()
        labels = np.split(lists.flatten().to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())[:-1])
        return Shared(np.stack([table.column(c).to_numpy() for c in setjoin.ROW]), labels, percent, budget)

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_regions(batches):
            if (kept := surviving(table, percent, budget)).any():
                yield from table.filter(pa.array(kept)).to_batches()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in setjoin.by_region(batches):
            lists = table.column("shingles").combine_chunks()
            begin = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            found = shared(table).links(lists.flatten().to_numpy(), begin)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    fields = ", ".join(f"{c} long" for c in setjoin.ROW) + ", labels array<long>"
    ordered = lambda frame: frame.repartition(*setjoin.KEY).sortWithinPartitions(*setjoin.KEY, "root", "g")
    # pairs of fitting size and fingerprints meet under every shingle that they share; the second pass leaves the first one
    near = settle(ordered(rows).mapInArrow(survivors, fields))
    near = settle(ordered(told_apart(near)).mapInArrow(survivors, fields))
    sets = sets_of(near.select("g").distinct()).select("g", F.array_sort("shingles").alias("shingles"))
    return ordered(near.join(sets, "g").select(*setjoin.ROW, "labels", "shingles")).mapInArrow(links, "a long, b long")


def path(fp: Column) -> Column:
    """The first PATH_BITS bits of a fingerprint, by which its leaf is sorted into a trie."""
    return F.shiftrightunsigned(fp[0], trie.WORD_BITS - PATH_BITS)


def _within(fp: Column, other: Column, budget: int) -> Column:
    return sum(F.bit_count(fp[k].bitwiseXOR(other[k])) for k in range(FP_WORDS)) <= budget


def linked(nodes: DataFrame, posted: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = PERCENT, budget: int = BUDGET) -> DataFrame:
    """(node, root): components of the links between sets (g, n, fp), without sets that have none.

    `posted` gives their shingles and places in the trie (g, n, path, rare); `sets_of` gives (g, shingles) for a frame of the sets (g) that have candidates.
    """
    met = settle(meetings(posted, "path"))
    pairs = met.where("before >= 0").select(F.col("before").alias("a"), F.col("g").alias("b"), F.lit(1).alias("depth"), F.col("before_n").alias("na"), F.col("n").alias("nb"))
    best = setjoin.best_of_each(pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
    prints = nodes.select("g", "fp")
    left = best.join(prints.select(F.col("g").alias("a"), F.col("fp").alias("fa")), "a")
    near = settle(left.join(prints.select(F.col("g").alias("b"), F.col("fp").alias("fb")), "b").where(_within(F.col("fa"), F.col("fb"), budget)).select("a", "b"))
    sets = sets_of(near.select(F.explode(F.array("a", "b")).alias("g")).distinct())
    links = settle(setjoin.confirmed(near, sets, percent))
    rooted = met.select("shingle", "n", "g").join(components(links).select(F.col("node").alias("g"), "root"), "g", "left").withColumn("root", F.coalesce("root", "g"))
    return components(links.unionByName(settle(across(under_shared(settle(rooted), prints), sets_of, percent, budget))))
