"""Where a pattern matches in a text, in code points, with built-in functions only.

Splitting a text at a pattern gives the gaps, extracting gives the matches; the running sum of
their lengths gives the places. A text of very many matches is summed in chunks, so that the
work stays far below the square of their number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256
LEFT_CHARS = 48
_SPAN = "array<struct<start:long,end:long,value:string,left:string>>"


def spans(text: Column, pattern: str, group: int = 0, prefilter: Column | None = None) -> Column:
    """array<struct<start, end, value, left>> of the leftmost non-overlapping matches: value is the
    given group, left the up to 48 characters between this match and the one before."""
    gaps, values, groups = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(values)), lambda g: F.struct(F.length(g).cast("long").alias("gap"), F.substring(g, -LEFT_CHARS, LEFT_CHARS).alias("left"))).alias("before"),
        F.transform(values, lambda v: F.length(v).cast("long")).alias("long"),
        groups.alias("value"),
    )
    none = F.array().cast(_SPAN)

    def one(state: Column, step: Column) -> Column:
        start = state["at"] + step["before"]["gap"]
        found = F.struct(start.alias("start"), (start + step["long"]).alias("end"), step["value"].alias("value"), step["before"]["left"].alias("left"))
        return F.struct((start + step["long"]).alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

    zero = F.lit(0).cast("long")
    chunk = lambda k: F.aggregate(F.slice(steps, k * CHUNK + 1, CHUNK), F.struct(zero.alias("at"), none.alias("found")), one)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")), chunk)

    def moved(state: Column, part: Column) -> Column:
        at = state["at"]
        shift = lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["value"].alias("value"), s["left"].alias("left"))
        return F.struct((at + part["at"]).alias("at"), F.concat(state["found"], F.array(F.transform(part["found"], shift))).alias("found"))

    start = F.struct(zero.alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))
    found = F.flatten(F.aggregate(chunks, start, moved)["found"])
    occurs = text.rlike(pattern) if prefilter is None else prefilter & text.rlike(pattern)
    return F.when(occurs, found).otherwise(none)


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined, of an array of structs with these fields."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
