"""Near duplicates by an LSH forest over MinHash signatures.

A document's set are its distinct word shingles. TREES * 4 minima of it under different hash
functions make the labels of TREES orders; documents that agree in the first parts of a label lie
next to each other there. Longest-common-prefix neighbours in those orders are the candidates, and a
region of an order is read as deep as it takes to be small (see `setjoin`). Every link is
confirmed on the full sets; equal sets are joined first and count once.

A pair of similarity s shares the four parts of a label with a chance of s^4. At 0.8 one of 20
trees shows it with 1 - (1 - 0.41)^20 = 0.99997, and a pair agrees in 46 of the 80 parts but for 3 in a million.
In regions that are small at two or three parts the chance is higher still.

Defined cases: null text, empty text and text without words have an empty set and are linked with
nothing; texts with fewer words than a shingle are one shingle; repeated rows are in one
component; a null doc_id is no component's smallest unless all are null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import WORD, located, text_of
from trastienda.llm.setjoin import PART_BITS, PARTS, linked
from trastienda.sources.settle import settle

SHINGLE, PERCENT = 4, 80
TREES = 20
#: Parts of a signature in which candidates agree.
AGREE = 46
#: Shingles whose minima are taken at once.
STEP = 256

_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles; fewer words are one shingle, no words none."""
    words = re.findall(WORD, text.translate(_LOWER))
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(" ".join(words), 1)] if words else [], "u8")
    each = np.fromiter(map(digest, words), "u8", count=len(words))
    mixed = each[: len(each) - size + 1].copy()
    for k in range(1, size):
        mixed ^= mixed >> np.uint64(31)
        mixed *= _ODD
        mixed += each[k : len(each) - size + 1 + k]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _ODD
    return np.unique(mixed)


def seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    """What a hash is xored with and then multiplied by, for each order of hashes."""
    made = np.array([[xxhash.xxh64_intdigest(f"{kind} {k}") for kind in ("turn", "times")] for k in range(count)], "u8")
    return made[:, :1].copy(), made[:, 1:] | np.uint64(1)


def labels(hashes: np.ndarray, by: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A label for each tree: the parts are minima of the set, each hashed to PART_BITS bits."""
    turn, times = by
    least = np.full(len(turn), np.iinfo("u8").max, "u8")
    for begin in range(0, len(hashes), STEP):
        mixed = hashes[None, begin : begin + STEP] ^ turn
        mixed *= times
        np.minimum(least, mixed.min(axis=1), out=least)
    parts = (least * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - PART_BITS)).reshape(-1, PARTS)
    whole = np.zeros(len(parts), "u8")
    for k in range(PARTS):
        whole = whole << np.uint64(PART_BITS) | parts[:, k]
    return whole.view("i8")


def prints(rows: DataFrame, size: int = SHINGLE, trees: int = TREES) -> DataFrame:
    """(place, doc_id, n, high, low, labels): a set's size, digest and labels."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = seeds(trees * PARTS)
        for batch in batches:
            found = [shingles(text.as_py(), size) for text in batch.column(2)]
            digest = np.array([divmod(xxhash.xxh3_128_intdigest(x.tobytes()), 1 << 64) for x in found], "u8").reshape(-1, 2).view("i8")
            marks = [labels(x, by) if len(x) else x.view("i8") for x in found]
            columns = [pa.array([len(x) for x in found], pa.int64()), *(pa.array(c) for c in digest.T.copy()), pa.array(marks, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["place", "doc_id", "n", "high", "low", "labels"])

    source = rows.select("place", "doc_id", "text")
    return source.mapInArrow(scan, f"place string, doc_id {source.schema['doc_id'].dataType.simpleString()}, n long, high long, low long, labels array<long>")


def shingle_sets(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(g, shingles) of (g, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([shingles(text.as_py(), size).view("i8")], pa.list_(pa.int64()))], ["g", "shingles"])

    return texts.select("g", "text").mapInArrow(scan, "g long, shingles array<long>")


def near_duplicates(docs: DataFrame, carry: Column | None = None, size: int = SHINGLE, percent: int = PERCENT, trees: int = TREES, agree: int = AGREE) -> DataFrame:
    """One row per document: key (`carry`, or the doc_id), n_shingles, component (the smallest key it is linked with, itself included)."""
    rows = located(docs, [(F.col("doc_id") if carry is None else carry).alias("doc_id"), text_of().alias("text")])
    found = settle(prints(rows, size, trees))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    same = found.where("n > 0").groupBy("high", "low").agg(F.min(order).alias("least"), F.min("place").alias("place"), F.first("n").alias("n"), F.first("labels").alias("labels"))
    nodes = settle(same.withColumn("g", F.monotonically_increasing_id()))
    in_orders = nodes.select("g", "n", F.posexplode("labels").alias("tree", "label"))

    def sets_of(wanted: DataFrame) -> DataFrame:
        places = nodes.select("g", "place").join(wanted, "g", "left_semi")
        return shingle_sets(rows.select("place", "text").join(places, "place"), size)

    roots = linked(in_orders, nodes, sets_of, percent, agree)
    member = settle(nodes.join(roots.select(F.col("node").alias("g"), "root"), "g", "left").select("high", "low", "least", F.coalesce("root", "g").alias("root")))
    least = member.groupBy("root").agg(F.min("least").alias("first"))
    labelled = settle(member.join(least, "root").select("high", "low", F.col("first.id").alias("component")))
    alone = found.where("n = 0").select(F.col("doc_id").alias("key"), F.col("n").alias("n_shingles"), F.col("doc_id").alias("component"))
    linked_rows = found.where("n > 0").select("doc_id", "n", "high", "low").join(labelled, ["high", "low"])
    return linked_rows.select(F.col("doc_id").alias("key"), F.col("n").alias("n_shingles"), "component").unionByName(alone)
