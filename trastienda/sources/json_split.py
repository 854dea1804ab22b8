"""One large JSON export, read in byte ranges and dealt out as JSON Lines.

A task that gets a range of bytes can't know how deep it begins, nor whether inside a string. So each
range is summed up as a function: for each way it may begin (after a lone backslash or not, inside a string or not)
how it ends and by how much the depth changes. These functions are applied one after another, a row per
range, and give the state in which every range begins. Then each range tells the last keys it holds on the two upper levels,
which are carried on to the ranges after it; and then it gives the entries of the blocks that begin in it, reading on past its end
for the last one. A task holds its range and one entry.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trastienda.sources.settle import settle, settle_lines

RANGE_BYTES = 8 << 20
#: Bytes read past a range at first; doubled until the last key or entry is complete.
TAIL_BYTES = 1 << 16
# Blocks whose entries lie in an array, the block of objects one level deeper, the block that is one object.
ARRAYS, NESTED, WHOLE = ("tiendas_info", "sku_mappings", "snapshots"), ("catalogo", "productos"), "metadata"
STATE = "path STRING, at BIGINT, offset BIGINT, size BIGINT, escaped INT, inside INT, depth BIGINT"
QUOTE, BACKSLASH = ord('"'), ord("\\")


def quotes(data: np.ndarray, escaped: int) -> tuple[np.ndarray, int]:
    """Where strings begin and end, and whether the byte after the data is escaped, if the first one is or isn't."""
    slash = np.concatenate([[False], data == BACKSLASH, [False]])
    edge = np.flatnonzero(slash[1:] != slash[:-1])
    begin, end = edge[::2], edge[1::2]
    # a run of backslashes escapes what follows if it is odd; an escaped first one doesn't count
    odd = (end - begin - ((begin == 0) & bool(escaped))) % 2 == 1
    hidden = np.zeros(len(data) + 1, "?")
    hidden[end[odd]] = True
    if escaped and len(data):
        hidden[0] = True
    after = bool(hidden[-1]) if len(data) else bool(escaped)
    return (data == QUOTE) & ~hidden[:-1], int(after)


def levels(data: np.ndarray, marks: np.ndarray, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether it is inside a string (with its first quote), and the depth after it."""
    within = (inside + np.cumsum(marks)) % 2 == 1
    step = np.isin(data, list(b"{[")).astype("i8") - np.isin(data, list(b"}]"))
    return within, depth + np.cumsum(np.where(within, 0, step))


def read(path: str, offset: int, size: int) -> np.ndarray:
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as source:
        return np.frombuffer(source.read_at(size, offset), "u1")


class Range:
    """A range of bytes whose begin is known, with as much of what follows as was asked for."""

    def __init__(self, row: dict, tail: int) -> None:
        self.data = read(row["path"], row["offset"], row["size"] + tail)
        self.size, self.complete = row["size"], len(self.data) < row["size"] + tail
        self.marks, _ = quotes(self.data, row["escaped"])
        self.within, self.depth = levels(self.data, self.marks, row["inside"], row["depth"])
        self.at = np.flatnonzero(self.marks)

    def keys(self) -> list[tuple[int, int, str]] | None:
        """(position, depth, key) of the keys on the first two levels that begin here; None if more must be read."""
        found = []
        begins = self.at[self.within[self.at] & (self.at < self.size) & (self.depth[self.at] <= 2)]
        ends = np.searchsorted(self.at, begins) + 1
        for begin, k in zip(begins.tolist(), ends.tolist(), strict=True):
            after = int(self.at[k]) + 1 if k < len(self.at) else len(self.data)
            while after < len(self.data) and self.data[after] in b" \t\r\n":
                after += 1
            if after >= len(self.data):
                if not self.complete:
                    return None
            elif self.data[after] == ord(":"):
                found.append((begin, int(self.depth[begin]), json.loads(self.data[begin : int(self.at[k]) + 1].tobytes())))
        return found

    def entries(self, key: str | None, below: str | None) -> list[str] | None:
        """The entries that begin here as documents of one entry; `key` and `below` are the keys before the range."""
        keys = self.keys()
        if keys is None:
            return None
        opening = np.flatnonzero((self.data[: self.size] == ord("{")) & ~self.within[: self.size])
        opening = opening[np.isin(self.depth[opening], (2, 3, 4))]
        closing = np.flatnonzero((self.data == ord("}")) & ~self.within)
        closing_of = {d: closing[self.depth[closing] == d - 1] for d in (2, 3, 4)}
        found, k = [], 0
        for begin in opening.tolist():
            while k < len(keys) and keys[k][0] < begin:
                if keys[k][1] == 1:
                    key, below = keys[k][2], None
                else:
                    below = keys[k][2]
                k += 1
            level = int(self.depth[begin])
            if (level, key) == (2, WHOLE):
                form = f'{{"{key}":%s}}'
            elif level == 3 and key in ARRAYS:
                form = f'{{"{key}":[%s]}}'
            elif level == 4 and (key, below) == NESTED:
                form = f'{{"{key}":{{"{below}":[%s]}}}}'
            else:
                continue
            ends = closing_of[level]
            end = int(np.searchsorted(ends, begin))
            if end == len(ends):
                if self.complete:
                    raise ValueError("the document ends inside an entry")
                return None
            # line breaks stand between values only
            text = self.data[begin : int(ends[end]) + 1].tobytes().decode("utf-8")
            found.append(form.replace("%s", text.replace("\r", " ").replace("\n", " "), 1))
        return found


def _longer(row: dict, ask) -> list:  # noqa: ANN001
    """What `ask` finds in a range, of which more is read until it is complete."""
    tail = TAIL_BYTES
    while (found := ask(Range(row, tail))) is None:
        tail *= 2
    return found


def ranges(spark: SparkSession, path: str, range_bytes: int) -> tuple[DataFrame, int]:
    """(path, at, offset, size), and how many ranges there are."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    step = F.lit(range_bytes)
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step)))
    rows = files.select("path", "length", parts.alias("at")).select("path", "at", (F.col("at") * step).alias("offset"), F.least(step, F.col("length") - F.col("at") * step).alias("size"))
    return rows, max(1, rows.count())


def begun(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """STATE of every range: whether its first byte is escaped, inside a string, and how deep."""
    rows, count = ranges(spark, path, range_bytes)
    ways = [(escaped, inside) for escaped in (0, 1) for inside in (0, 1)]

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, ends = read(row["path"], row["offset"], row["size"]), []
                for escaped, inside in ways:
                    marks, after = quotes(data, escaped)
                    within, depth = levels(data, marks, inside, 0)
                    ends += [after, int(within[-1]), int(depth[-1])]
                yield pa.RecordBatch.from_pylist([{**row, "ends": ends}], pa.schema([("path", pa.string()), ("at", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("ends", pa.list_(pa.int64()))]))

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        frame, state, states = frame.sort_values("at"), (0, 0, 0), []
        for ends in frame["ends"]:
            states.append(state)
            k = ways.index(state[:2]) * 3
            state = (int(ends[k]), int(ends[k + 1]), state[2] + int(ends[k + 2]))
        if state != (0, 0, 0):
            raise ValueError(f"{frame['path'].iloc[0]} isn't a whole JSON document")
        return frame.drop(columns="ends").assign(**{name: [s[i] for s in states] for i, name in enumerate(("escaped", "inside", "depth"))})

    summed = rows.repartition(count, "path", "at").mapInArrow(sum_up, "path STRING, at BIGINT, offset BIGINT, size BIGINT, ends ARRAY<BIGINT>")
    return settle(summed.groupBy("path").applyInPandas(follow, STATE)), count


def as_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> str:
    """A folder of JSON Lines, one for each entry of the export at the path (a file or a folder of documents).

    Line breaks between values are blanks there. Of the blocks only what the export is read for goes on.
    """
    states, count = begun(spark, path, range_bytes)

    def last_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = _longer(row, Range.keys)
                first = [k for k in keys if k[1] == 1][-1:]
                second = [k for k in keys if k[1] == 2 and (not first or k[0] > first[0][0])][-1:]
                yield pa.RecordBatch.from_pylist(
                    [{**row, "key": first[0][2] if first else None, "below": second[0][2] if second else None}], schema
                )

    schema = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("at", "offset", "size")], ("escaped", pa.int32()), ("inside", pa.int32()), ("depth", pa.int64()), ("key", pa.string()), ("below", pa.string())])
    keyed = settle(states.repartition(count, "path", "at").mapInArrow(last_keys, f"{STATE}, key STRING, below STRING"))
    earlier = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    changed = F.when(F.col("key").isNotNull() | F.col("below").isNotNull(), F.struct("below"))
    known = keyed.select(*states.columns, F.last("key", True).over(earlier).alias("key"), F.last(changed, True).over(earlier)["below"].alias("below"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = _longer(row, lambda part, row=row: part.entries(row["key"], row["below"]))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["line"])

    return settle_lines(settle(known).repartition(count, "path", "at").mapInArrow(entries, "line STRING"), "jsonl")
