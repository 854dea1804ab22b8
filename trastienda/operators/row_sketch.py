"""Which rows differ between two tables that should be the same, without shuffling either of them.

Totals can agree although rows differ. Each side is summed up in an invertible sketch: every row
falls into PLACES cells, and a cell keeps how many rows fell into it and the exclusive or of their key hashes, row
hashes and check sums. The sketches have a fixed size, add up over tasks, and are subtracted. What both
sides have cancels out; a cell that is left with one row gives it away, and taking that row out of its other cells leaves
further ones with a single row. If that empties all cells, the keys found name all rows that differ, and only those are
fetched and compared. If too many differ for the sketch, the rows are compared in full by a shuffle.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of a sketch, and cells a row falls into; about two thirds as many differences as cells can be read off.
CELLS, PLACES = 6144, 3


def sketch(rows: DataFrame, key: list[str], values: list[str], cells: int = CELLS) -> DataFrame:
    """(cell, n, key_xor, row_xor, check_xor): at most `cells` rows, however large the table is."""
    hashed = rows.select(F.xxhash64(*key).alias("key"), F.xxhash64(*[_marked(c) for c in (*key, *values)]).alias("row"))
    name = F.concat_ws(":", "key", "row").cast("binary")
    part = cells // PLACES
    places = F.array(*[(F.crc32(F.concat(F.lit(f"{k}:").cast("binary"), name)) % part + k * part).cast("int") for k in range(PLACES)])
    return hashed.select(F.explode(places).alias("cell"), "key", "row", F.crc32(name).alias("check")).groupBy("cell").agg(
        F.count("*").alias("n"), F.bit_xor("key").alias("key_xor"), F.bit_xor("row").alias("row_xor"), F.bit_xor("check").alias("check_xor")
    )


def peeled(left: DataFrame, right: DataFrame, cells: int = CELLS) -> set[int] | None:
    """The hashes of the keys whose rows differ, from the sketches of both sides; None if they can't all be read off."""
    both = left.unionByName(right.withColumn("n", -F.col("n"))).groupBy("cell").agg(
        F.sum("n").alias("n"), *[F.bit_xor(c).alias(c) for c in ("key_xor", "row_xor", "check_xor")]
    )
    held = {r.cell: [r.n, r.key_xor, r.row_xor, r.check_xor] for r in both.collect()}
    part, open_cells, found = cells // PLACES, list(held), set()
    while open_cells:
        n, key, row, check = held[open_cells.pop()]
        name = f"{key}:{row}".encode()
        if abs(n) != 1 or zlib.crc32(name) != check:
            continue
        found.add(key)
        for k in range(PLACES):
            cell = zlib.crc32(f"{k}:".encode() + name) % part + k * part
            now = held.setdefault(cell, [0, 0, 0, 0])
            held[cell] = [now[0] - n, now[1] ^ key, now[2] ^ row, now[3] ^ check]
            open_cells.append(cell)
    return None if any(any(cell) for cell in held.values()) else found


def differing_rows(left: DataFrame, right: DataFrame, key: list[str], values: list[str], cells: int = CELLS) -> DataFrame:
    """(key, values, surplus): rows that `left` has more often (surplus above zero) or less often than `right`; NULL equals NULL."""
    columns = [*key, *values]
    keys = peeled(sketch(left, key, values, cells), sketch(right, key, values, cells), cells)
    if keys is not None:
        # no more keys than the sketch has cells
        some = left.sparkSession.createDataFrame([(k,) for k in sorted(keys)], "_key bigint")
        left, right = (side.withColumn("_key", F.xxhash64(*key)).join(F.broadcast(some), "_key", "left_semi") for side in (left, right))
    counted = left.select(*columns, F.lit(1).alias("n")).unionByName(right.select(*columns, F.lit(-1).alias("n")))
    return counted.groupBy(*columns).agg(F.sum("n").alias("surplus")).where("surplus <> 0")


def _marked(column: str):  # noqa: ANN202
    """A value with its own mark for NULL, since a hash of several columns skips NULLs."""
    return F.struct(F.col(column).isNull(), F.col(column))
