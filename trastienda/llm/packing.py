"""Pack documents into training sequences by local search.

Documents are tokenised and cut in tasks of their own; only (document, piece, length) goes
on. Full pieces are sequences by themselves. The others are dealt evenly into shards of
bounded size. In a shard a best-fit pass opens the bins; then the search takes the
lightest bin and moves documents out of it, or exchanges one for one, two for one or one
for two with fuller bins. Each step carries tokens from a lighter to a heavier bin, which
increases the sum of squared fills, until a bin is empty or no step is left. Bins with the
same room are looked up together by the sizes and sums of two that they hold, as bit sets, so a
step costs by room and not by pairs of bins or pieces. It ends early once the number of bins is
the least that any packing needs.

Defined cases: null text is empty text, whose document is the end token alone; repeated rows
are packed each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import text_of
from trastienda.sources.settle import settle

if TYPE_CHECKING:
    from tokenizers import Tokenizer

LENGTH = 1024
END = 2
VOCABULARY = "byte_bpe_50k"
#: Pieces of a shard; a shard leaves less than one bin unfilled that a single packing would fill.
SHARD_PIECES = 8192
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """The ids that `tokenizers` gives for the vocabulary's .json, from the same vocabulary as ranks.

    The vocabulary is read from the node's own copy, whose place is a parameter.
    """

    SPECIAL = "<|endoftext|>"
    made: dict[str, Encoder] = {}

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.vocabulary, self.whole = vocabulary, None
        self.encoding = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={self.SPECIAL: len(ranks)})

    @classmethod
    def of(cls, vocabulary: str) -> Encoder:
        if vocabulary not in cls.made:
            cls.made[vocabulary] = cls(vocabulary)
        return cls.made[vocabulary]

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special={self.SPECIAL})
        except ValueError:  # its pattern can't backtrack over about a million blanks in a row
            return np.array(self.tokenizer().encode(text, add_special_tokens=False).ids, "<u4")

    def tokenizer(self) -> Tokenizer:
        """The vocabulary's own tokenizer, read when first needed."""
        if self.whole is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(public_tokenizers.path(f"{self.vocabulary}.json"))
        return self.whole


def cut(count: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first."""
    first = (count - 1) % length + 1
    return [(0, first), *((start, length) for start in range(first, count, length))]


def tokens(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """One row per piece; with `with_ids` also its token ids as an array."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(vocabulary), np.array([END], dtype="<u4")
        for batch in batches:
            rows: list[tuple] = []
            kept: list[np.ndarray] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encoder.ids(text.as_py()).astype("<u4", copy=False), end])
                for piece, (start, size) in enumerate(cut(len(ids), length)):
                    part = ids[start : start + size]
                    rows.append((doc_id, piece, start, size, zlib.crc32(part.tobytes())))
                    if with_ids:
                        kept.append(part)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return source.mapInArrow(encode, PIECES + ", ids array<int>" * with_ids)


class Bins:
    """Bins of one shard: for each its pieces, and the bins with room ordered by room."""

    def __init__(self, sizes: np.ndarray, length: int) -> None:
        self.sizes, self.length = sizes.tolist(), length
        self.known: dict[int, tuple[int, int]] = {}
        self.by_room: dict[int, set[int]] = {}
        self.unions: dict[int, tuple[int, int]] = {}
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        rooms: list[list[int]] = [[] for _ in range(length + 1)]
        with_room: list[int] = []
        for item in np.argsort(-sizes, kind="stable").tolist():
            size = self.sizes[item]
            k = bisect_left(with_room, size)
            if k == len(with_room):
                self.items.append([item])
                self.fill.append(size)
                bin_, room = len(self.items) - 1, length - size
            else:
                room = with_room[k]
                bin_ = rooms[room].pop()
                if not rooms[room]:
                    del with_room[k]
                self.items[bin_].append(item)
                self.fill[bin_] += size
                room -= size
            if room:
                if not rooms[room]:
                    insort(with_room, room)
                rooms[room].append(bin_)

    def least(self) -> int:
        """Bins that any packing needs: by tokens, and since of pieces over a k-th of a bin it holds fewer than k."""
        ordered = sorted(self.sizes, reverse=True)
        return max([-(-sum(ordered) // self.length), *(-(-bisect_left(ordered, -(self.length // k), key=lambda x: -x) // (k - 1)) for k in range(2, self.length + 1))])

    def sums(self, bin_: int) -> tuple[int, int]:
        """Bit sets: the sizes of the bin's pieces, and the sums of two of them."""
        if bin_ not in self.known:
            ones = twos = 0
            for item in self.items[bin_]:
                twos |= ones << self.sizes[item]
                ones |= 1 << self.sizes[item]
            self.known[bin_] = ones, twos
        return self.known[bin_]

    def search(self) -> None:
        """Empty the lightest bins as long as that is possible."""
        self.by_room, self.unions = {}, {}
        for bin_ in range(len(self.items)):
            self.enter(bin_)
        waiting = self.open_bins()
        used, least = sum(1 for x in self.items if x), self.least()
        while used > least and waiting:
            fill, donor = heappop(waiting)
            if fill != self.fill[donor]:
                if 0 < self.fill[donor] < self.length:
                    heappush(waiting, (self.fill[donor], donor))
            elif self.drain(donor):
                used -= 1
                waiting = self.open_bins()

    def open_bins(self) -> list[tuple[int, int]]:
        return sorted((self.length - room, bin_) for room, members in self.by_room.items() for bin_ in members)

    def enter(self, bin_: int) -> None:
        """Put an open bin among those with the same room."""
        if 0 < self.fill[bin_] < self.length:
            room = self.length - self.fill[bin_]
            self.by_room.setdefault(room, set()).add(bin_)
            if room in self.unions:
                self.unions[room] = tuple(a | b for a, b in zip(self.unions[room], self.sums(bin_), strict=True))

    def leave(self, bin_: int) -> None:
        room = self.length - self.fill[bin_]
        members = self.by_room[room]
        members.discard(bin_)
        self.unions.pop(room, None)
        if not members:
            del self.by_room[room]

    def union(self, room: int) -> tuple[int, int]:
        """The sums of all bins with that room. What the union can give back, one of its bins can."""
        if room not in self.unions:
            ones = twos = 0
            for bin_ in self.by_room[room]:
                one, two = self.sums(bin_)
                ones, twos = ones | one, twos | two
            self.unions[room] = ones, twos
        return self.unions[room]

    def drain(self, donor: int) -> bool:
        """Steps out of the donor, into the bins with most room first, until it is empty or none is left."""
        self.leave(donor)
        moved = True
        while moved and self.items[donor]:
            moved = False
            for room in sorted(self.by_room, reverse=True):
                while self.items[donor] and room in self.by_room and room <= self.length - self.fill[donor]:
                    own = self.sums(donor)
                    gain = best_gain(own, self.union(room), room)
                    if not gain:
                        break
                    taker = min(bin_ for bin_ in self.by_room[room] if carries(own, self.sums(bin_), gain))
                    self.leave(taker)
                    self.give(donor, taker)
                    self.enter(taker)
                    moved = True
        self.enter(donor)
        return not self.items[donor]

    def give(self, donor: int, taker: int) -> bool:
        """The step between two bins that carries the most tokens to the fuller one."""
        room = self.length - self.fill[taker]
        if not room or self.fill[taker] < self.fill[donor]:
            return False
        own, other = self.sums(donor), self.sums(taker)
        gain = best_gain(own, other, room)
        if not gain:
            return False
        one_back, two_back = (own[0] >> gain) & (1 | other[0] | other[1]), (own[1] >> gain) & (1 | other[0])
        going = lowest(one_back or two_back) + gain
        out = self.of_sum(donor, going, own[0] if one_back else 0)
        back = self.of_sum(taker, going - gain, other[0])
        self.items[donor] = [x for x in self.items[donor] if x not in out] + back
        self.items[taker] = [x for x in self.items[taker] if x not in back] + out
        self.fill[donor] -= gain
        self.fill[taker] += gain
        self.known.pop(donor, None)
        self.known.pop(taker, None)
        return True

    def of_sum(self, bin_: int, total: int, ones: int) -> list[int]:
        """No piece, one or two of a bin that have this sum; one if its size is among `ones`."""
        if not total:
            return []
        seen: dict[int, int] = {}
        for item in self.items[bin_]:
            size = self.sizes[item]
            if ones >> total & 1:
                if size == total:
                    return [item]
            elif total - size in seen:
                return [seen[total - size], item]
            seen[size] = item
        raise AssertionError("no such pieces")


def lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def carries(out: tuple[int, int], back: tuple[int, int], gain: int) -> bool:
    """Can one piece go for none, one or two, or two for none or one, with this gain?"""
    return bool((out[0] >> gain) & (1 | back[0] | back[1]) or (out[1] >> gain) & (1 | back[0]))


def best_gain(out: tuple[int, int], back: tuple[int, int], room: int) -> int:
    """The largest gain that fits the room; 0 if no step has one."""
    for gain in range(min(room, max(out).bit_length() - 1), 0, -1):
        if carries(out, back, gain):
            return gain
    return 0


def pack_sizes(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each size its bin and its offset there."""
    bins, where, offset = Bins(sizes, length), np.zeros(len(sizes), "int64"), np.zeros(len(sizes), "int64")
    bins.search()
    for number, items in enumerate(x for x in bins.items if x):
        place = 0
        for item in items:
            where[item], offset[item] = number, place
            place += bins.sizes[item]
    return where, offset


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(settle(tokens(docs, length, vocabulary)), length, shard_pieces)


def place(pieces: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Places for pieces that lie in files, so that a task that runs again numbers them alike."""
    numbered = pieces.withColumn("number", F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") == length).select(*pieces.columns, (F.col("number") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = numbered.where(F.col("length") < length)
    shards = max(1, -(-rest.count() // shard_pieces))
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards).cast("long"))).drop("number")

    def shard(frame: pd.DataFrame) -> pd.DataFrame:
        bin_, offset = pack_sizes(frame["length"].to_numpy(), length)
        return frame.assign(sequence_id=((frame["shard"].to_numpy() << 32) + bin_) * 2 + 1, offset=offset).drop(columns="shard")

    # small rows, long work: shards aren't put together again
    packed = dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(shard, dealt.drop("shard").schema.simpleString()[7:-1].replace(":", " ") + ", sequence_id long, offset long")
    return whole.unionByName(packed)
