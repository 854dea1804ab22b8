"""Runs of periodic words, by Baier's grouping of suffixes.

The first phase of Baier's suffix sorter puts suffixes into groups by the longest Lyndon word
they begin with; the length of that word is all this module keeps: the Lyndon array. It is
built under an order of the words and under the reversed order. Every run has a Lyndon word
of its period as its root under one of both, so each entry (i, p) is a candidate, and the longest
common extensions of i and i + p to both sides give the run.

Only stretches that can hold a run asked for are grouped: inside a run of period q that
repeats often enough, the k words at each place (k at most q) occurred at most q places earlier, for
more than q places in a row. Whether that is so for some q between two powers of two is read off
the whole text at once. The condition is necessary, so nothing is lost by it.

Defined cases: null and empty texts and such without words have no runs; repeated rows are
judged each; a null doc_id alters no words; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import WORD, text_of

#: A run repeats its period at least so often, and has at least so many words.
REPEATS, LEAST = 4, 6
Run = tuple[int, int, int]


def word_ids(words: list[str]) -> np.ndarray:
    """Equal words have equal numbers; any order of the words serves."""
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), "i8", count=len(words))


def lyndon_array(ids: np.ndarray) -> list[int]:
    """The length of the longest Lyndon word that begins at each place.

    Groups of suffixes lie next to each other in `order`, the smaller group first; a group is named by
    where it begins. The groups are taken from the greatest down. Each member has the nearest
    earlier suffix of a smaller group; those suffixes move to a new group just above their own, whose
    word is theirs followed by the member's word, once for each member that names them.
    """
    n = len(ids)
    if not n:
        return []
    by_word = np.argsort(ids, kind="stable")
    ranked = ids[by_word]
    first = np.flatnonzero(np.diff(ranked, prepend=ranked[0] - 1))
    begin = np.repeat(first, np.diff(first, append=n))
    group_of = np.empty(n, "i8")
    group_of[by_word] = begin
    at_of = np.empty(n, "i8")
    at_of[by_word] = np.arange(n)
    order, group, at = by_word.tolist(), group_of.tolist(), at_of.tolist()
    size = dict(zip(first.tolist(), np.diff(first, append=n).tolist(), strict=True))
    length = dict.fromkeys(size, 1)
    before, found = [-1] * n, [0] * n
    end = n
    while end:
        name = group[order[end - 1]]
        word = length[name]
        members = order[name:end]
        members.sort()
        named: dict[int, int] = {}
        for i in members:
            found[i] = word
            j = i - 1
            while j >= 0 and group[j] >= name:
                j = before[j]
            before[i] = j
            if j >= 0:
                named[j] = named.get(j, 0) + 1
        end = name
        moves: dict[tuple[int, int], list[int]] = defaultdict(list)
        for j, times in named.items():
            moves[-times, group[j]].append(j)
        for times, old in sorted(moves):
            moved = moves[times, old]
            top = old + size[old]
            for j in moved:
                top -= 1
                other, place = order[top], at[j]
                order[place], order[top] = other, j
                at[other], at[j] = place, top
            size[old] = top - old
            size[top] = len(moved)
            length[top] = length[old] - times * word
            for j in moved:
                group[j] = top
    return found


def extension(ids: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and j on, in the direction of `step`, are the same (i < j)."""
    room = len(ids) - j if step > 0 else i + 1
    got, block = 0, 16
    while got < room:
        take = min(block, room - got)
        if step > 0:
            differ = np.flatnonzero(ids[i + got : i + got + take] != ids[j + got : j + got + take])
            same = int(differ[0]) if len(differ) else take
        else:
            differ = np.flatnonzero(ids[i - got - take + 1 : i - got + 1] != ids[j - got - take + 1 : j - got + 1])
            same = take - 1 - int(differ[-1]) if len(differ) else take
        got += same
        if same < take:
            break
        block *= 4
    return got


def stretches(ids: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> list[tuple[int, int]]:
    """(begin, end) of disjoint stretches that hold every run with so many repeats and words.

    For periods q in (half, full], full a power of two and k = max(1, half): each of the places
    start + q .. end - k repeats the k words that begin q earlier, and there are
    length - q - k + 1 of them, at least (repeats - 1) * q - k + 1.
    """
    n, found, full, grams = len(ids), [], 1, ids.astype("u8")
    while full // 2 + 1 <= n // repeats:
        half = full // 2
        k, q = max(1, half), half + 1
        need = max((repeats - 1) * q - k + 1, least - full - k + 1, 1)
        by_gram = np.argsort(grams, kind="stable")
        ranked = grams[by_gram]
        again = np.flatnonzero(ranked[1:] == ranked[:-1])
        if not len(again):
            break  # no k words occur twice, so no longer ones do
        gap = by_gram[again + 1] - by_gram[again]
        near = np.zeros(len(grams) + 2, "i1")
        near[by_gram[again + 1][gap <= full] + 1] = 1
        edge = np.diff(near)
        up, down = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = down - up >= need
        found += zip(np.maximum(up[long] - full, 0).tolist(), np.minimum(down[long] - 1 + k, n).tolist(), strict=True)
        if full > 1:  # from k words to 2k
            mixed = grams * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            grams = mixed[: len(grams) - k] * np.uint64(0xBF58476D1CE4E5B9) + grams[k:]
        full *= 2
    merged: list[tuple[int, int]] = []
    for begin, end in sorted(found):
        if merged and begin <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((begin, end))
    return merged


def runs(ids: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> list[Run]:
    """(start, length, period) of the runs of at least `repeats` periods and `least` words, sorted.

    A run that repeats four times has at least three roots one after another, so only the first of
    three equal entries a period apart is extended; with fewer repeats every entry is.
    """
    found: dict[tuple[int, int], int] = {}
    for begin, end in stretches(ids, repeats, least):
        part = ids[begin:end]
        for ranks in (part, part.max() - part):
            words = np.array(lyndon_array(ranks))
            place = np.arange(len(part))
            follow = place + words
            for _ in range(min(2, repeats - 2)):
                good = np.flatnonzero(follow < len(part))
                good = good[words[follow[good]] == words[place[good]]]
                place, follow = place[good], follow[good] + words[place[good]]
            covered: dict[int, int] = {}
            for i in place.tolist():
                period, at = int(words[i]), begin + i
                if at < covered.get(period, 0):
                    continue
                right = extension(ids, at, at + period, 1) if at + period < len(ids) else 0
                left = extension(ids, at - 1, at + period - 1, -1) if at else 0
                length = left + period + right
                if length >= 2 * period:
                    covered[period] = at - left + length - period + 1
                if length >= max(least, repeats * period, 2 * period):
                    found[at - left, period] = length
    return sorted((start, length, period) for (start, period), length in found.items())


def altered(words: list[str], doc_id: int | None) -> list[str]:
    """The contract's test repeats: a tenth of the documents repeat some words from some place on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def collapsed(words: list[str], found: list[Run]) -> list[str]:
    """The words without those that a run contains after its first period."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, "i8")
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def strongest(found: list[Run]) -> Run | None:
    """The run with the greatest exact length / period, then the smallest start and period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def period_runs(docs: DataFrame, carry: Column | None = None, alter: bool = False, with_text: bool = False) -> DataFrame:
    """One row per document: `key` (`carry`, or the doc_id) and FIELDS; with `with_text` also the runs and the collapsed text.

    `alter` repeats words by the doc_id first, as the contract of the query wants it.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = re.findall(WORD, text.as_py())
                if alter:
                    words = altered(words, doc_id)
                found = runs(word_ids(words))
                best = strongest(found)
                top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
                listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
                short = " ".join(collapsed(words, found))
                rows.append((len(found), *top, sha256(listed.encode()).hexdigest(), sha256(short.encode()).hexdigest(), *(([dict(zip(("start", "length", "period"), r, strict=True)) for r in found], short) if with_text else ())))
            types = [*[pa.int64()] * 5, pa.string(), pa.string(), *([kinds, pa.string()] if with_text else [])]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(types), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", *(f.split()[0] for f in FIELDS.split(", ")), *(["runs", "collapsed"] if with_text else [])])

    key = (F.col("doc_id") if carry is None else carry).alias("key")
    source = docs.select(key, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    extra = ", runs array<struct<start:long,length:long,period:long>>, collapsed string" * with_text
    return source.mapInArrow(scan, f"key {source.schema['key'].dataType.simpleString()}, {FIELDS}{extra}")
