"""Language identification by compression.

For each language a bounded sample of labelled text becomes a raw-content dictionary of
zstandard. A text is reduced to its letters and cut into blocks, each block is compressed once
with every dictionary, and the language whose dictionary gives the fewest bytes over all
blocks wins. Blocks keep a long text from being its own dictionary, so that every part of it
counts alike. A text for which the runner-up needs hardly more bytes is rejected: it is too
short to tell, or hardly made of words of a known language.

Defined cases: null text, and text without a letter, are `und` with score 0 and rejected;
without any labelled text everything is `und`; rows with null lang teach nothing; repeated
rows are predicted alike; equal sizes go to the language with most labelled rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import text_of

#: The sample that a language's dictionary is made of: so many documents, so many characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 64, 500
BLOCK_CHARS = 1024
LEVEL = 9
#: Rejected: the winner saves less than this part of the bytes that the runner-up needs.
MIN_MARGIN = 0.01
UND = "und"
_APART = re.compile(r"[\W\d_]+")
LETTER = r"\p{L}"
PREDICTED = "lang_pred string, score double, margin double, accepted boolean"


class Dictionaries(NamedTuple):
    """The languages from the most to the least labelled one. Bounded by SAMPLE_DOCS x SAMPLE_CHARS characters a language."""

    names: list[str]
    contents: list[bytes]


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Dictionaries:
    """Dictionaries from (text, lang): of each language the documents with the smallest hash of a bucket, a stretch of each."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).select("lang", "text", F.xxhash64("text").alias("deal"))
    # the smallest hash of each bucket, so that tasks pass on no more than the sample's size
    chosen = rows.groupBy("lang", F.pmod("deal", F.lit(sample_docs)).alias("bucket")).agg(F.min("deal").alias("deal")).drop("bucket")
    begin = F.pmod("deal", F.greatest(F.length("text") - sample_chars, F.lit(0)).cast("long") + 1).cast("int") + 1
    stretch = F.col("text").substr(begin, F.lit(sample_chars)).alias("stretch")
    # the sample is bounded, so it goes to the texts
    found = rows.join(F.broadcast(chosen), ["lang", "deal"]).select("lang", "deal", stretch).distinct().orderBy("lang", "deal", "stretch").collect()
    often = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    names = sorted({row["lang"] for row in found}, key=lambda name: (-often[name], name))
    return Dictionaries(names, [" ".join(letters(row["stretch"]) for row in found if row["lang"] == name).encode() for name in names])


def letters(text: str) -> str:
    return _APART.sub(" ", text.lower())


class Scales:
    """Compressors of one task."""

    def __init__(self, dictionaries: Dictionaries, level: int) -> None:
        self.each = []
        for content in dictionaries.contents:
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self.each.append(zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False))

    def weigh(self, text: str) -> list[int]:
        """Bytes with each dictionary."""
        text = letters(text)
        blocks = [text[k : k + BLOCK_CHARS].encode("utf-8", "replace") for k in range(0, len(text), BLOCK_CHARS)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.each]


def judge(sizes: list[int]) -> tuple[int, float, float]:
    """(winner, score, margin). The score is the winner's share if a byte less doubles the odds; the
    margin is the distance to the runner-up as a part of the runner-up's bytes."""
    winner = sizes.index(min(sizes))
    score = 1 / float(np.exp2(-np.minimum(np.array(sizes) - sizes[winner], 1000.0)).sum())
    second = min((size for k, size in enumerate(sizes) if k != winner), default=0)
    return winner, score, (second - sizes[winner]) / second if second else 1.0


def predict(docs: DataFrame, dictionaries: Dictionaries, carry: Column, level: int = LEVEL, min_margin: float = MIN_MARGIN) -> DataFrame:
    """(key, lang_pred, score, margin, accepted) of each whole text; `carry` becomes the key."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        scales = Scales(known, level)
        for batch in batches:
            out: list[tuple] = []
            for text, lettered in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                if not lettered or not known.names:
                    out.append((UND, 0.0, 0.0, False))
                    continue
                winner, score, margin = judge(scales.weigh(text.as_py()))
                out.append((known.names[winner], score, margin, margin >= min_margin))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "lang_pred", "score", "margin", "accepted"])

    source = docs.select(carry.alias("key"), text_of().alias("text")).withColumn("lettered", F.col("text").rlike(LETTER))
    return source.mapInArrow(scan, f"key {source.schema['key'].dataType.simpleString()}, {PREDICTED}")


def keep_known(docs: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """The documents that aren't rejected, with their own columns."""
    source = docs.select(F.struct("*").alias("row"), text_of().alias("text"))
    return predict(source, dictionaries, F.col("row")).where("accepted").select("key.*")
