"""Links between sets of shingles, given rows that bring similar sets next to each other.

A row (g, tree, label, n) puts set `g` of size `n` into an order: sets whose labels in a tree begin with the same
parts lie in one region of it. Links are found in two rounds, each confirmed on the full
sets, so that a dense group of near copies is joined by few comparisons before all pairs count:

1. neighbours in the sorted orders, for each set the one it shares the longest prefixes with;
2. in each region that still holds several components, all pairs between those. Signatures drop the sets
   that agree with none of another component; the others meet with their full sets in the region's task, where
   a link joins two components at once, so that only what isn't similar is compared with everything.

The orders are sorted by ranges, so a group of any size is split evenly, and neighbours across two
ranges are joined by the ranges' ends. Regions are read as deep as it takes to have few rows; those that stay
large at the last depth are compared block by block, blocks being bounded in rows and in shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trastienda.llm.components import components
from trastienda.sources.settle import settle

#: A label holds so many parts of so many bits, the first part in the highest bits.
PARTS, PART_BITS = 4, 16
#: Sets are neighbours from so many equal parts on.
LEAST_DEPTH = 2
#: A region with more rows is read one part deeper; at the last depth it is dealt into blocks of so many rows.
REGION, BLOCK = 256, 1024
#: Shingles of a block, about.
BLOCK_SHINGLES = 1 << 21


def depth(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many parts two labels share from the first on."""
    same = np.zeros(len(left), "i8")
    for part in range(1, PARTS + 1):
        same += left >> (PARTS - part) * PART_BITS == right >> (PARTS - part) * PART_BITS
    return same


def neighbours(rows: DataFrame) -> DataFrame:
    """(a, b, depth, na, nb): sets next to each other in some order, with at least LEAST_DEPTH parts in common."""
    names = ["g", "tree", "label", "n"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, first = TaskContext.get().partitionId(), None, None
        for batch in batches:
            now = np.stack([batch.column(c).to_numpy() for c in names])
            if not now.shape[1]:
                continue
            if first is None:
                first = now[:, :1]
            both = now if last is None else np.concatenate([last, now], axis=1)
            x, y = both[:, :-1], both[:, 1:]
            same = depth(x[2], y[2])
            near = (x[1] == y[1]) & (same >= LEAST_DEPTH) & (x[0] != y[0])
            x, y, same = x[:, near], y[:, near], same[near]
            none = np.zeros(len(same), "i8")
            yield _batch(x[0], y[0], same, x[3], y[3], none, none - 1, none)
            last = now[:, -1:]
        if last is not None:
            ends = np.concatenate([first, last], axis=1)
            yield _batch(ends[0], ends[0], ends[1], ends[3], ends[3], np.array([part] * 2), np.array([0, 1]), ends[2])

    kept = "a long, b long, depth long, na long, nb long, part long, side long, label long"
    ordered = rows.select(*[F.col(c).cast("long").alias(c) for c in names]).repartitionByRange("tree", "label", "n", "g").sortWithinPartitions("tree", "label", "n", "g")
    found = settle(ordered.mapInArrow(scan, kept))
    # the ends of the ranges: two rows a task
    by = Window.orderBy("part", "side")
    ends = found.where("side >= 0").select("part", "side", F.col("depth").alias("tree"), F.col("label"), F.col("a").alias("g"), F.col("na").alias("n"))
    before = ends.select("*", *[F.lag(c).over(by).alias(f"last_{c}") for c in ("tree", "label", "g", "n")])
    shared = sum((F.shiftright("label", k * PART_BITS) == F.shiftright("last_label", k * PART_BITS)).cast("long") for k in range(PARTS))
    across = before.where((F.col("side") == 0) & (F.col("tree") == F.col("last_tree")) & (F.col("g") != F.col("last_g"))).select(F.col("last_g").alias("a"), F.col("g").alias("b"), shared.alias("depth"), F.col("last_n").alias("na"), F.col("n").alias("nb"))
    return found.where("side < 0").select("a", "b", "depth", "na", "nb").unionByName(across.where(f"depth >= {LEAST_DEPTH}"))


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "depth", "na", "nb", "part", "side", "label"])


def _sizes_fit(na: Column, nb: Column, percent: int) -> Column:
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def best_of_each(pairs: DataFrame) -> DataFrame:
    """(a, b): for each set the neighbour that shares most parts with it, over all orders."""
    scored = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("depth").alias("score"))
    ends = scored.select("a", "b", "score", F.explode(F.array("a", "b")).alias("g"))
    best = ends.groupBy("g").agg(F.max(F.struct("score", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets (g, shingles) have 100 * intersection >= percent * union."""
    left = pairs.join(sets.select(F.col("g").alias("a"), F.col("shingles").alias("left")), "a")
    both = left.join(sets.select(F.col("g").alias("b"), F.col("shingles").alias("right")), "b")
    common = F.size(F.array_intersect("left", "right"))
    return both.where(common * 100 >= (F.size("left") + F.size("right") - common) * percent).select("a", "b")


def regions(rows: DataFrame, roots: DataFrame | None) -> DataFrame | None:
    """(g, n, root, tree, region, blocks): rows of regions with several components, as deep as needed to be small; `tree` tells the depth as well."""
    labels = rows.withColumn("root", F.col("g")) if roots is None else rows.join(roots.select(F.col("node").alias("g"), "root"), "g", "left").withColumn("root", F.coalesce("root", "g"))
    open_rows, found = settle(labels.select("g", "n", "root", "tree", "label")), None
    for parts in range(LEAST_DEPTH, PARTS + 1):
        keyed = open_rows.withColumn("region", F.shiftright("label", (PARTS - parts) * PART_BITS))
        mixed = keyed.groupBy("tree", "region").agg(F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high"), F.sum("n").alias("shingles"))
        blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
        mixed = settle(mixed.where("low < high").select("tree", "region", "members", blocks.alias("blocks")))
        small = mixed if parts == PARTS else mixed.where(F.col("members") <= REGION)
        part = keyed.join(small, ["tree", "region"]).select("g", "n", "root", (F.col("tree") * (PARTS + 1) + parts).alias("tree"), "region", "blocks")
        found = part if found is None else found.unionByName(part)
        large = mixed.where(F.col("members") > REGION)
        if parts == PARTS or not large.take(1):
            return found
        open_rows = settle(keyed.join(large.select("tree", "region"), ["tree", "region"], "left_semi").drop("region"))
    return found


KEY = ["tree", "region", "low", "high"]
ROW = [*KEY, "root", "g", "n", "block"]


def dealt(found: DataFrame, signatures: DataFrame) -> DataFrame:
    """The regions' rows with their signatures, dealt into pairs of blocks."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = found.withColumn("block", F.pmod(F.xxhash64("g"), F.col("blocks"))).withColumn("other", other)
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return rows.join(signatures.select("g", "labels"), "g").select(*[F.col(c).cast("long").alias(c) for c in ROW], "labels")


class Region:
    """The rows of one pair of blocks of a region, sorted by root and g."""

    def __init__(self, rows: np.ndarray, marks: np.ndarray, percent: int, agree: int) -> None:
        self.percent, self.agree, self.marks = percent, agree, marks
        self.tree, self.one_block = int(rows[0, 0]) // (PARTS + 1), rows[2, 0] == rows[3, 0]
        self.root, self.g, self.n, self.block = rows[4].copy(), rows[5], rows[6], rows[7]

    def candidates(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Later rows of other components that may be similar to row i, and in how many parts they agree."""
        others = np.flatnonzero(self.root[i + 1 :] != self.root[i]) + i + 1
        if not self.one_block:
            others = others[self.block[others] != self.block[i]]
        n = self.n[others]
        others = others[100 * np.minimum(n, self.n[i]) >= self.percent * np.maximum(n, self.n[i])]
        same = self.marks[others] == self.marks[i]
        count = same.sum(axis=1)
        good = count >= self.agree
        if self.tree:
            # sets with an equal label in an earlier tree meet there
            good &= ~same[:, : self.tree * PARTS].reshape(len(same), self.tree, PARTS).all(axis=2).any(axis=1)
        return others[good], count[good]

    def surviving(self) -> np.ndarray:
        found = np.zeros(len(self.g), "?")
        for i in range(len(self.g) - 1):
            others, _ = self.candidates(i)
            found[others] = True
            found[i] |= len(others) > 0
        return found

    def links(self, flat: np.ndarray, begin: np.ndarray) -> list[tuple[int, int]]:
        """Links that join all similar rows; row k's sorted set is flat[begin[k] : begin[k + 1]]."""
        found = []
        for i in range(len(self.g) - 1):
            others, count = self.candidates(i)
            while len(others):
                # of each other component the row that agrees most, then the rest of those that remain apart
                order = np.lexsort((-count, self.root[others]))
                others, count = others[order], count[order]
                first = np.diff(self.root[others], prepend=-1) != 0
                for j in others[first][self.similar(i, others[first], flat, begin)].tolist():
                    if self.root[j] != self.root[i]:
                        found.append((int(self.g[i]), int(self.g[j])))
                        self.root[self.root == self.root[j]] = self.root[i]
                rest = ~first & (self.root[others] != self.root[i])
                others, count = others[rest], count[rest]
        return found

    def similar(self, i: int, others: np.ndarray, flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
        own, size = flat[begin[i] : begin[i + 1]], begin[others + 1] - begin[others]
        edge = np.concatenate([[0], np.cumsum(size)])
        values = flat[np.arange(edge[-1]) + np.repeat(begin[others] - edge[:-1], size)]
        hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
        both = np.add.reduceat(hit.astype("i8"), edge[:-1])
        return both * 100 >= (size + len(own) - both) * self.percent


def by_region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of sorted batches cut between pairs of blocks; the last one may go on in the next batch."""
    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = (pa.concat_tables([held, now]) if held is not None else now).combine_chunks()
        key = np.stack([now.column(c).to_numpy() for c in KEY])
        edge = (np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()
        for begin, end in zip([0, *edge], edge, strict=False):
            yield now.slice(begin, end - begin)
        held = now.slice(edge[-1] if edge else 0)
    if held is not None and held.num_rows:
        yield held


def across(rows: DataFrame, sets: DataFrame, percent: int, agree: int) -> DataFrame:
    """(a, b): links between different components of `dealt` rows, confirmed on the sets (g, shingles)."""

    def region(table: pa.Table) -> Region:
        marks = table.column("labels").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).view("u2")
        return Region(np.stack([table.column(c).to_numpy() for c in ROW]), marks, percent, agree)

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_region(batches):
            if table.num_rows > 1 and (kept := region(table).surviving()).any():
                yield from table.filter(pa.array(kept)).to_batches()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_region(batches):
            lists = table.column("shingles").combine_chunks()
            begin = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            found = region(table).links(lists.flatten().to_numpy(), begin)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    fields = ", ".join(f"{c} long" for c in ROW) + ", labels array<long>"
    ordered = lambda frame: frame.repartition(*KEY).sortWithinPartitions(*KEY, "root", "g")
    near = settle(ordered(rows).mapInArrow(survivors, fields))
    whole = near.join(sets.select("g", F.array_sort("shingles").alias("shingles")), "g").select(*ROW, "labels", "shingles")
    return ordered(whole).mapInArrow(links, "a long, b long")


def linked(rows: DataFrame, signatures: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, agree: int) -> DataFrame:
    """(node, root): components of the links between sets, without sets that have none.

    `rows`: (g, tree, label, n); `signatures`: (g, labels); `sets_of` gives (g, shingles) for a frame of the sets (g) that have candidates.
    """
    near = settle(neighbours(rows))
    sets = settle(sets_of(near.select(F.explode(F.array("a", "b")).alias("g")).distinct()))
    fitting = near.where(_sizes_fit(F.col("na"), F.col("nb"), percent))
    links = settle(confirmed(best_of_each(fitting), sets, percent))
    known = rows.join(sets.select("g"), "g", "left_semi").select("g", F.col("n").cast("long").alias("n"), "tree", "label")
    apart = dealt(regions(known, components(links)), signatures)
    return components(links.unionByName(settle(across(apart, sets, percent, agree))))
