"""Align the tokens of two tokenizers over the same bytes by pointer jumping.

Both tokenizers cut the same bytes. Every token points to the token that overlaps it and
reaches farthest right; a token that no other one reaches beyond points to the end of its group.
Doubling the pointers of all tokens of a batch of documents at once (each points to
where its target points) converges after about log2 of the longest chain to the last token
of each group of overlapping tokens, which names the group.

The last tokens of a group end together and are linked. The bytes of one of the two are then a suffix
of the other's, so the two vocabularies bound the pairs that can be linked at all (`possible_pairs`),
however large the corpus is; only the counts of those are collected and broadcast.

Both tokenizers begin a token at a single space inside a text, so texts are cut there into stretches, which
are aligned once and then looked up: the groups of a text are those of its stretches one after another.

Defined cases: null and empty texts, and texts whose joined tokens of either tokenizer aren't a space and
the text, have no tokens; repeated rows are aligned each; an empty table gives an empty result; other columns
are ignored. Strings of special tokens are plain text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import text_of
from trastienda.sources.settle import settle

LEFT, RIGHT = "byte_bpe_50k", "piece_bpe_32k"
#: Bytes of text that are aligned at once.
BATCH_BYTES = 1 << 20
#: Aligned stretches that a worker remembers, and the characters of the longest of them.
REMEMBERED, SHORT = 1 << 19, 64
BLANK = "▁"
#: Neither tokenizer joins bytes across a single space between two other characters, so both end a token before it.
STRETCH = re.compile(r"(?<=\S) (?=\S)")


class ByteTokens:
    """Byte-level BPE of a space and the text, with the bytes of each id.

    The vocabulary's ranks are read by `tiktoken`, which gives the ids of the `tokenizers` file several times as fast;
    where its pattern can't backtrack over a very long run of blanks, that file is read instead.
    """

    def __init__(self, name: str) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.name, self.whole = name, None
        self.bytes: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str], cut: list[list[str]] | None = None) -> list[np.ndarray]:
        return [self.one(" " + text) for text in texts]

    def one(self, text: str) -> np.ndarray:
        try:
            return np.array(self.encoding.encode_ordinary(text), "i8")
        except ValueError as error:
            if "backtracking" not in str(error):
                raise
            return np.array(self.file().encode(text, add_special_tokens=False).ids, "i8")

    def file(self):  # noqa: ANN201
        if self.whole is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))
            self.whole.encode_special_tokens = True
        return self.whole


class PieceTokens:
    """BPE pieces with byte fallback, which put the space before the text themselves."""

    def __init__(self, name: str) -> None:
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
        size = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(self.model.id_to_piece(list(range(size))))]

    def ids(self, texts: list[str], cut: list[list[str]] | None = None) -> list[np.ndarray]:
        parts = [[text] for text in texts] if cut is None else cut
        return [np.array(list(chain.from_iterable(self.model.encode(part, num_threads=1))), "i8") for part in parts]


@cache
def tokenizer(name: str) -> ByteTokens | PieceTokens:
    """The tokenizer of a name, read once for each worker from the node's own files."""
    return PieceTokens(name) if name.startswith("piece") else ByteTokens(name)


def possible_pairs(left: list[bytes | None], right: list[bytes | None]) -> int:
    """How many pairs can end together: those of which one's bytes are a suffix of the other's."""
    def suffixes(these: list[bytes | None], those: list[bytes | None]) -> set[tuple[bytes, bytes]]:
        known = {x for x in those if x}
        return {(x, x[k:]) for x in these if x for k in range(len(x)) if x[k:] in known}

    longer, shorter = suffixes(left, right), suffixes(right, left)
    times = {id(t): {} for t in (left, right)}
    for t in (left, right):
        for x in t:
            if x:
                times[id(t)][x] = times[id(t)].get(x, 0) + 1
    a, b = times[id(left)], times[id(right)]
    pairs = longer | {(y, x) for x, y in shorter}
    return sum(a[x] * b[y] for x, y in pairs)


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of both sides the number of its group's last token, by pointer jumping.

    The ends ascend over all documents of a batch, whose bytes lie one after another; tokens of side b
    are numbered after those of side a. A group's last token is the one of side a.
    """
    n = len(ends_a)
    # the token of the other side that holds a token's last byte reaches farthest right of those that overlap it
    to_b, to_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    pointer = np.concatenate([np.where(ends_b[to_b] > ends_a, n + to_b, np.arange(n)), to_a])
    while True:
        doubled = pointer[pointer]
        if (doubled == pointer).all():
            return pointer[:n], pointer[n:]
        pointer = doubled


def align(texts: list[str], left: ByteTokens | PieceTokens, right: ByteTokens | PieceTokens, cut: list[list[str]] | None = None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: ids of both sides, and the positions after the last token of each group on both sides.

    `cut` may give the texts in stretches, for a tokenizer that is faster on short texts.
    """
    a, b = left.ids(texts, cut), right.ids(texts, cut)
    none = np.zeros(0, "i8")
    for k, text in enumerate(texts):
        whole = b" " + text.encode()
        if not text or any(b"".join(map(side.bytes.__getitem__, ids.tolist())) != whole for side, ids in ((left, a[k]), (right, b[k]))):
            a[k] = b[k] = none
    long_a, long_b = _lengths(left), _lengths(right)
    all_a, all_b = np.concatenate(a) if a else none, np.concatenate(b) if b else none
    if not len(all_a):
        return [(none, none, none, none)] * len(texts)
    # tokens without bytes (there are none in these vocabularies) would belong to the group before them
    ends_a, ends_b = np.cumsum(long_a[all_a]), np.cumsum(long_b[all_b])
    last_a, last_b = groups(ends_a, ends_b)
    cut_a, cut_b = np.flatnonzero(np.diff(last_a, append=-1)) + 1, np.flatnonzero(np.diff(last_b, append=-1)) + 1
    found, from_a, from_b, from_group = [], 0, 0, 0
    for ids_a, ids_b in zip(a, b, strict=True):
        to_group = int(np.searchsorted(cut_a, from_a + len(ids_a), "right"))
        found.append((ids_a, ids_b, cut_a[from_group:to_group] - from_a, cut_b[from_group:to_group] - from_b))
        from_a, from_b, from_group = from_a + len(ids_a), from_b + len(ids_b), to_group
    return found


def _lengths(side: ByteTokens | PieceTokens) -> np.ndarray:
    if not hasattr(side, "lengths"):
        side.lengths = np.array([len(x or b"") for x in side.bytes], "i8")
    return side.lengths


@cache
def marks(left: int, right: int) -> list[str]:
    """Each id with what follows it: `,` or `|` after one of so many left ids, `,` or `;` after a right one."""
    return [f"{k}{mark}" for size, ends in ((left, ",|"), (right, ",;")) for mark in ends for k in range(size)]


def written(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size_a: int, size_b: int) -> list[str]:
    """The parts of `a1,a2|b1;a3|b2,b3;`, token by token: of each group first the left, then the right ids."""
    group_a, group_b = (np.repeat(np.arange(len(cut)), np.diff(cut, prepend=0)) for cut in (cut_a, cut_b))
    code_a, code_b = ids_a.copy(), ids_b + 2 * size_a
    code_a[cut_a - 1] += size_a
    code_b[cut_b - 1] += size_b
    codes = np.empty(len(ids_a) + len(ids_b), "i8")
    codes[np.arange(len(ids_a)) + np.concatenate([[0], cut_b])[group_a]] = code_a
    codes[np.arange(len(ids_b)) + cut_a[group_b]] = code_b
    return list(map(marks(size_a, size_b).__getitem__, codes.tolist()))


class Stretches:
    """Aligned stretches by number: tokens of both sides, linked pairs, and the groups as written."""

    def __init__(self, left: ByteTokens | PieceTokens, right: ByteTokens | PieceTokens) -> None:
        self.sides = left, right
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        self.count, self.uses = np.zeros((0, 3), "i8"), np.zeros(0, "i8")
        self.begin, self.pairs = np.zeros(1, "i8"), np.zeros(0, "i8")

    def forget(self) -> None:
        """Keep the stretches that were looked up more than once since the last time, or none if those are too many as well."""
        kept = [(x, k) for x, k in self.number.items() if self.uses[k] > 1]
        if len(kept) > REMEMBERED // 2:
            kept = []
        at = np.array([k for _, k in kept], "i8")
        text, pairs, count = [self.text[k] for k in at.tolist()], self.pairs[self.places(at)], self.count[at]
        self.number, self.text = {x: k for k, (x, _) in enumerate(kept)}, text
        self.count, self.uses = count, np.zeros(len(at), "i8")
        self.begin, self.pairs = np.concatenate([[0], np.cumsum(count[:, 2])]), pairs

    def places(self, at: np.ndarray) -> np.ndarray:
        """Where the pairs of these stretches stand, one stretch after another."""
        size = self.count[at, 2]
        at, size = at[size > 0], size[size > 0]
        if not len(at):
            return np.zeros(0, "i8")
        begin, steps = self.begin[at], np.ones(size.sum(), "i8")
        steps[0] = begin[0]
        steps[np.cumsum(size)[:-1]] = begin[1:] - begin[:-1] - size[:-1] + 1
        return np.cumsum(steps)

    def add(self, stretches: list[str]) -> None:
        """Align these, which are new, and number them on.

        Joined by spaces they are a text that both tokenizers cut there again, so they are aligned in one go;
        those for which that doesn't hold are aligned alone.
        """
        joint = [x for x in stretches if x and not x[0].isspace() and not x[-1].isspace() and BLANK not in x]
        alone = [x for x in stretches if not x or x[0].isspace() or x[-1].isspace() or BLANK in x]
        if joint and not self.enter(joint, *align([" ".join(joint)], *self.sides, [joint])[0]):
            alone += joint
        for stretch, found in zip(alone, align(alone, *self.sides), strict=True):
            self.enter([stretch], *found)

    def enter(self, names: list[str], ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bool:
        """Keep the groups of stretches that were aligned as one text, unless a group reaches over one's end."""
        ends = np.cumsum([len(x.encode()) + 1 for x in names])
        groups_end = np.cumsum(_lengths(self.sides[0])[ids_a])[cut_a - 1]
        upto = np.searchsorted(groups_end, ends) + 1
        if not len(cut_a):
            upto = np.zeros(len(names), "i8")
        if len(names) > 1 and not (len(cut_a) and (groups_end[upto - 1] == ends).all()):
            return False
        last = np.stack([cut_a[upto - 1], cut_b[upto - 1], upto], axis=1) if len(cut_a) else np.zeros((len(names), 3), "i8")
        parts, from_ = written(ids_a, ids_b, cut_a, cut_b, *(len(side.bytes) for side in self.sides)), 0
        for name, to in zip(names, (last[:, 0] + last[:, 1]).tolist(), strict=True):
            self.number[name] = len(self.text)
            self.text.append("".join(parts[from_:to])[:-1])
            from_ = to
        self.count = np.concatenate([self.count, np.diff(last, axis=0, prepend=0)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + upto])
        self.pairs = np.concatenate([self.pairs, ids_a[cut_a - 1] << 32 | ids_b[cut_b - 1]])
        self.uses = np.concatenate([self.uses, np.zeros(len(names), "i8")])
        return True

    def of(self, texts: list[str]) -> list[tuple[tuple[int, int, int], str, np.ndarray, np.ndarray]]:
        """For each text its tokens on both sides and its groups, these as written, its distinct pairs and how often each occurs."""
        # cut at every space; a part with white space at an end wasn't cut between two other characters
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        parts, size = split.flatten().dictionary_encode(), pc.list_value_length(split).to_numpy()
        words, index = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        edge = np.concatenate([[0], np.cumsum(size)])
        odd = np.array([not x or x[0].isspace() or x[-1].isspace() for x in words], "?")[index]
        uneven = np.flatnonzero(np.add.reduceat(odd, edge[:-1])).tolist() if len(odd) else []
        again = {k: STRETCH.split(texts[k]) for k in uneven}
        new = set(words).union(*again.values()).difference(self.number)
        if len(self.number) + len(new) > REMEMBERED:
            self.forget()
            new = set(words).union(*again.values()).difference(self.number)
        self.add(list(new))
        number = np.fromiter(map(self.number.__getitem__, words), "i8", count=len(words))[index]
        none, found = np.zeros(0, "i8"), []
        for k, (begin, end) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            at = np.fromiter(map(self.number.__getitem__, again[k]), "i8") if k in again else number[begin:end]
            counts = self.count[at]
            if not texts[k] or not counts[:, 0].all():
                found.append(((0, 0, 0), "", none, none))
                continue
            pair, times = np.unique(self.pairs[self.places(at)], return_counts=True)
            found.append((tuple(counts.sum(axis=0).tolist()), ";".join(map(self.text.__getitem__, at.tolist())), pair, times))
        self.uses += np.bincount(number, minlength=len(self.uses))
        for stretch in [x for x in new if len(x) > SHORT]:
            del self.number[stretch]
        return found


@cache
def stretches(left: str, right: str) -> Stretches:
    """What a worker remembers, from one task to the next."""
    return Stretches(tokenizer(left), tokenizer(right))


def aligned(docs: DataFrame, carry: Column | None = None, left: str = LEFT, right: str = RIGHT, with_groups: bool = False) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked `pairs` (a << 32 | b) with their `times`.

    With `with_groups` also the groups themselves, as the digest's text.
    """
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", *(["groups"] if with_groups else [])]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = stretches(left, right)
        for batch in batches:
            begin, weight, sizes = 0, 0, pc.binary_length(batch.column(1)).to_pylist()
            for end in range(1, batch.num_rows + 1):
                weight += sizes[end - 1]
                if weight >= BATCH_BYTES or end == batch.num_rows:
                    yield rows(batch.column(0).slice(begin, end - begin), known.of(batch.column(1).slice(begin, end - begin).to_pylist()))
                    begin, weight = end, 0

    def rows(keys: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        counts = np.array([(*x[0], x[0][2]) for x in found], "i8")
        digests = [sha256(x[1].encode()).hexdigest() if x[1] else "" for x in found]
        lists = [pa.array([x[k] for x in found], pa.list_(pa.int64())) for k in (2, 3)]
        whole = [pa.array([x[1] for x in found], pa.string())] if with_groups else []
        return pa.RecordBatch.from_arrays([keys, *(pa.array(c) for c in counts.T.copy()), pa.array(digests, pa.string()), *lists, *whole], names)

    source = docs.select((F.col("doc_id") if carry is None else carry).alias("key"), text_of().alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(scan, f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>" + ", groups string" * with_groups)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, a, b, links, best): how many links of the corpus hold each pair; best if no pair of its b has more."""
    each = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("links"))
    counts = settle(counts.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "links"))
    top = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(top, "b").select("pair", "a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, carry: Column | None = None, left: str = LEFT, right: str = RIGHT) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = settle(aligned(docs, carry, left, right))
    spark = docs.sparkSession
    counts = pair_counts(found)
    # bounded by the vocabularies, whatever the corpus: one of two linked tokens is a suffix of the other
    bound = possible_pairs(tokenizer(left).bytes, tokenizer(right).bytes)
    table = counts.select("pair", "links", "best").limit(bound + 1).toArrow()
    if table.num_rows > bound:
        raise RuntimeError(f"more than the {bound} pairs that can end together")
    order = np.argsort(table["pair"].to_numpy())
    sent = spark.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("pair", "links", "best")))
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, links, best = sent.value
        for batch in batches:
            counts, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(pair, counts)
            sizes = pc.list_value_length(batch.column("pairs")).to_numpy()
            edge = np.concatenate([[0], np.cumsum(sizes)])
            total = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * links[at])]
            sums = [pa.array(t[edge[1:]] - t[edge[:-1]], pa.int64()) for t in total]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *sums], [*names, "n_best", "count_sum"])

    kind = found.schema["key"].dataType.simpleString()
    return found.mapInArrow(weigh, f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
