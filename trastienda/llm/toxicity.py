"""Toxic passages as maximal scoring segments of token log-odds.

Tokens are hashed into a fixed number of slots. From labelled documents each slot gets the
log-odds of toxic against other text, with a Dirichlet prior in proportion to the slot's
overall frequency, shrunk by its standard error. A document counts once for each of its
slots, since a word that one document repeats tells no more than that document. Scores are shifted down by a drift so that
ordinary text loses; then every significant passage is a maximal scoring segment,
and one scan finds them all (Ruzzo and Tompa). Chance makes segments too: their scores follow
an extreme value law whose two parameters come from the score frequencies of other text
(Karlin and Altschul). A segment's surprise is -ln of its E-value in a text of that length; a
document's evidence combines its best segment and the sum of its significant ones, and
two-way counts of labelled evidence turn it into a probability.

Fitting takes a bounded sample of the labelled documents of each class; the calibration weighs
the classes by their true sizes.

Defined cases: null and empty texts have no passage and get the score of no evidence;
without toxic labels every score is 0; labels that are null teach nothing; repeated
rows score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import text_of
from trastienda.sources.settle import settle

#: Slots of token weights; what is collected, broadcast and held in a task is bounded by it.
SLOTS = 1 << 18
#: Weight of the prior as a part of all counts.
PRIOR = 0.01
#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE_ROWS = 16_384
#: Standard errors that a log-odds ratio is shrunk by.
SHRINK = 1.0
DRIFT = 2.0
#: Expected number of such segments by chance in a text, at most.
E_VALUE = 0.01
#: Evidence is counted in steps of half a unit up to 200.
STEPS = 400
TOKEN = re.compile(r"[^\W\d_]+|\d+")
#: Words whose slots a task remembers.
REMEMBERED = 1 << 20


class Model(NamedTuple):
    scores: np.ndarray
    decay: float
    size: float
    chance: np.ndarray


class Slots(dict):
    """Slot of a token, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        slot = zlib.crc32(token.encode("utf-8", "replace")) & (SLOTS - 1)
        if len(self) < REMEMBERED:
            self[token] = slot
        return slot

    def of(self, text: str) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, TOKEN.findall(text.lower())), "int32")


def sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[DataFrame, dict[int, float]]:
    """Of each class the doc_ids with the smallest hash of a bucket, and how many labelled ones each stands for.

    The sample's size is bounded, so it can be broadcast and texts stay where they are.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id").alias("deal"))
    least = F.min(F.struct("deal", "doc_id")).alias("first")
    chosen = settle(known.groupBy("toxic", F.pmod("deal", F.lit(rows)).alias("bucket")).agg(least, F.count("*").alias("n")).select("first.doc_id", "toxic", "n"))
    sizes = chosen.groupBy("toxic").agg((F.sum("n") / F.count("*")).alias("each")).collect()
    return chosen.select("doc_id", "toxic"), {row["toxic"]: row["each"] for row in sizes}


def count_slots(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(documents, tokens) by label and slot, from (text, toxic); each task adds up its own before the shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, counts = Slots(), np.zeros((2, 2, SLOTS), "int64")
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                slot, tokens = np.unique(slots.of(text.as_py()), return_counts=True)
                counts[0, toxic, slot] += 1
                counts[1, toxic, slot] += tokens
        label, slot = np.nonzero(counts[0])
        names = ["label", "slot", "docs", "tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (label.astype("int32"), slot.astype("int32"), counts[0, label, slot], counts[1, label, slot])], names)

    source = labelled.select(text_of().alias("text"), F.col("toxic").cast("int").alias("toxic"))
    sums = source.mapInArrow(scan, "label int, slot int, docs long, tokens long").groupBy("label", "slot").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    found = sums.toPandas()
    out = np.zeros((2, 2, SLOTS))
    for k, name in enumerate(("docs", "tokens")):
        out[k, found["label"].to_numpy("int64"), found["slot"].to_numpy("int64")] = found[name].to_numpy("float64")
    return out[0], out[1]


def weigh(docs: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(score of each slot, lambda, K)."""
    if not docs[1].sum() or not docs[0].sum():
        return np.full(SLOTS, -DRIFT), 1.0, 1.0
    prior = PRIOR * docs.sum(axis=0)
    some = prior > 0
    sides = [docs[k][some] + prior[some] for k in (0, 1)]
    whole = [side.sum() for side in sides]
    odds = np.log(sides[1] / (whole[1] - sides[1])) - np.log(sides[0] / (whole[0] - sides[0]))
    error = np.sqrt(1 / sides[0] + 1 / sides[1])
    scores = np.full(SLOTS, -DRIFT)
    scores[some] += np.sign(odds) * np.maximum(np.abs(odds) - SHRINK * error, 0.0)
    share = tokens[0] / tokens[0].sum()
    seen = share > 0
    # lambda is the positive root of E[exp(lambda s)] = 1 over the tokens of other text
    low, high = 1e-3, 50.0
    for _ in range(100):
        middle = (low + high) / 2
        terms = np.log(share[seen]) + middle * scores[seen]
        low, high = (middle, high) if terms.max() < 0 and np.exp(terms).sum() < 1 else (low, middle)
    return scores, low, max(float(share[scores > 0].sum()), 1e-9)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), left to right, in linear time.

    Neighbours of the same sign belong together, so runs of one sign are one step of the scan.
    """
    if not len(scores):
        return []
    positive = scores > 0
    if not positive.any():
        return []
    edge = np.flatnonzero(np.diff(positive)) + 1
    starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(scores)]])
    sums = np.add.reduceat(scores, starts)
    # candidates: (start, end, total before it, total with it); `lower` is the last one that begins below
    stack: list[tuple[int, int, float, float]] = []
    lower: list[int] = []
    total = 0.0
    for start, end, value in zip(starts.tolist(), ends.tolist(), sums.tolist(), strict=True):
        if value <= 0:
            total += value
            continue
        begin, left, right = start, total, total + value
        total = right
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= left:
                k = lower[k]
            if k < 0 or stack[k][3] >= right:
                stack.append((begin, end, left, right))
                lower.append(k)
                break
            begin, left = stack[k][0], stack[k][2]
            del stack[k:], lower[k:]
    return [(begin, end, right - left) for begin, end, left, right in stack]


def evidence(slots: np.ndarray, model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """A document's evidence and its significant passages (first token, end, surprise)."""
    scores = model.scores[slots]
    base = math.log(max(len(slots), 1) * model.size)
    found = [(a, b, model.decay * s - base) for a, b, s in segments(scores)]
    toxic = [x for x in found if x[2] >= -math.log(E_VALUE)]
    best = max((x[2] for x in found), default=0.0)
    return max(0.0, best) + sum(x[2] for x in toxic) - max([0.0, *(x[2] for x in toxic)]), toxic


def step(value: float) -> int:
    return min(int(2 * value), STEPS)


def scan_evidence(docs: DataFrame, model: Model, carry: Column) -> DataFrame:
    """(key, evidence, n_passages, score) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, known = Slots(), shared.value
        for batch in batches:
            rows = [evidence(slots.of(text.as_py()), known) for text in batch.column(1)]
            values = np.array([value for value, _ in rows], "float64")
            chance = known.chance[np.minimum((2 * values).astype("int64"), STEPS)]
            passages = pa.array([len(found) for _, found in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), passages, pa.array(chance)], ["key", "evidence", "n_passages", "score"])

    source = docs.select(carry.alias("key"), text_of().alias("text"))
    return source.mapInArrow(scan, f"key {source.schema['key'].dataType.simpleString()}, evidence double, n_passages int, score double")


def monotone(counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Part of toxic documents by step of evidence, never falling (pooled neighbours), 0 where there is no label."""
    blocks: list[list[float]] = []
    for n, k in zip(counts, toxic, strict=True):
        blocks.append([float(n), float(k), 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n1, k1, w1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n1, blocks[-1][1] + k1, blocks[-1][2] + w1]
    return np.concatenate([np.full(int(w), k / n if n else 0.0) for n, k, w in blocks])


def learn(labelled: DataFrame, weights: dict[int, float] | None = None) -> Model:
    """From rows with text and toxic (0 or 1): weights, chance law and the calibration of the evidence.

    `weights` says how many documents a row of each class stands for.
    """
    rows = labelled.where("toxic IN (0, 1)")
    raw = Model(*weigh(*count_slots(rows)), np.zeros(STEPS + 1))
    seen = scan_evidence(rows, raw, F.col("toxic").cast("int"))
    steps = seen.groupBy("key", F.least(F.floor(F.col("evidence") * 2), F.lit(STEPS)).alias("step")).count().collect()
    by = np.zeros((2, STEPS + 1))
    for row in steps:
        by[row["key"], row["step"]] += row["count"] * (weights or {}).get(row["key"], 1.0)
    return raw._replace(chance=monotone(by.sum(axis=0), by[1]))


def score(docs: DataFrame, model: Model, carry: Column) -> DataFrame:
    """(key, evidence, n_passages, score 0 to 1)."""
    return scan_evidence(docs, model, carry)
