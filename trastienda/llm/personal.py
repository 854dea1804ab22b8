"""Personal data: fixed patterns, and contexts that bootstrap further identifiers from them.

Matches of the fixed patterns are the seeds. The one or two words left of an
instance are a lexical pattern. Patterns and instances (values) form a bipartite graph, which is scored in
rounds: a pattern's confidence is the mean confidence of the distinct values that follow it, an
unknown value's is that of not every one of its trusted patterns being wrong. Candidates for unknown
values are tokens with many digits. What stands in the context of a pattern that is trusted in
the end is an identifier too.

Main path: DataFrame functions only.

Defined cases: null text is empty text and has no spans; repeated rows count once as evidence,
since values count by their distinct texts; without seeds nothing is trusted; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import located, text_of
from trastienda.llm.spans import joined, spans
from trastienda.sources.settle import settle

# The four base patterns. Possessive repeats and the look behind don't change what
# is found; they keep long runs from being tried again from each of their characters.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: Tokens that may be identifiers: so many digits at least.
CANDIDATE = r"(?<![A-Za-z0-9@._+/-])[A-Za-z0-9@._+/-]*[0-9][A-Za-z0-9@._+/-]*"
MIN_DIGITS = 5
FOUND = "found"
ROUNDS = 3
#: A pattern is trusted from this mean confidence on, and from so many distinct values that are believed.
TRUST, SUPPORT = 0.75, 4


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.split(F.reverse(_digits(value)), "")
    term = lambda d, k: F.when(k % 2 == 0, d.cast("int")).when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
    return F.aggregate(F.transform(digits, term), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid() -> dict[str, tuple[str, Column, Callable[[Column], Column]]]:
    """By kind its pattern, a cheap test of the text, and the test of a match."""
    text = F.col("text")
    bare = lambda part: F.ltrim(part, F.lit("0"))
    small = lambda part: (F.length(bare(part)) <= 3) & (F.right(F.concat(F.lit("000"), bare(part)), F.lit(3)).cast("int") <= 255)
    return {
        "email": (EMAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        "ip": (IP, F.lit(True), lambda v: F.forall(F.split(v, r"\."), small)),
        "card": (CARD, F.lit(True), lambda v: F.length(_digits(v)).between(13, 19) & _luhn(v)),
        "phone": (PHONE, F.contains(text, F.lit("+")), lambda v: F.length(_digits(v)).between(9, 15)),
    }


def _context(left: Column) -> Column:
    """The last two words, digits as zeros."""
    words = F.split(F.trim(F.lower(F.translate(left, "\t\n\r\f\x0b", "     "))), " +")
    return F.regexp_replace(F.concat_ws(" ", F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2))), "[0-9]", "0")


def _seeds(kind: str, good: Callable[[Column], Column]) -> Column:
    fields = lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _context(s["left"]).alias("context"))
    return F.transform(F.filter(F.col(kind), lambda s: good(s["value"])), fields)


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def scan(docs: DataFrame) -> DataFrame:
    """place, doc_id, base (kind, start, end, value, context) and candidates (start, end, value, context) of each whole text."""
    rows = located(docs, [F.col("doc_id"), text_of().alias("text")]).withColumn("digit", F.col("text").rlike("[0-9]"))
    for kind, (pattern, cheap, _) in _valid().items():
        rows = rows.withColumn(kind, spans(F.col("text"), pattern, prefilter=cheap if kind == "email" else cheap & F.col("digit")))
    rows = rows.withColumn("candidates", spans(F.col("text"), CANDIDATE, prefilter=F.col("digit"))).drop("text", "digit")
    kinds = [_seeds(kind, good) for kind, (_, _, good) in _valid().items()]
    rows = rows.withColumn("base", F.concat(*kinds)).drop(*KINDS)
    many = F.filter("candidates", lambda s: F.length(_digits(s["value"])) >= MIN_DIGITS)
    named = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _context(s["left"]).alias("context"))
    free = F.filter(F.transform(many, named), lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return rows.withColumn("candidates", free)


def trusted_patterns(scanned: DataFrame, rounds: int = ROUNDS, trust: float = TRUST, support: int = SUPPORT) -> DataFrame:
    """(context): the patterns that are trusted after the rounds."""
    seeds = scanned.select(F.explode("base").alias("x")).select("x.context", "x.value", F.lit(1.0).alias("belief"))
    others = scanned.select(F.explode("candidates").alias("x")).select("x.context", "x.value", F.lit(0.0).alias("belief"))
    edges = settle(seeds.unionByName(others).where("context <> ''").groupBy("context", "value").agg(F.max("belief").alias("seed")))
    values = edges.select("context", "value", F.col("seed").alias("belief"), "seed")
    for _ in range(rounds):
        score = F.avg("belief")
        patterns = settle(values.groupBy("context").agg(score.alias("trust"), F.count_if(F.col("belief") >= trust).alias("support")).where((F.col("trust") >= trust) & (F.col("support") >= support)))
        # what isn't a seed is believed unless all its trusted patterns are wrong
        doubt = edges.where("seed = 0").join(patterns, "context").groupBy("value").agg(F.sum(F.log(1.0 - F.least("trust", F.lit(0.999)))).alias("doubt"))
        values = settle(edges.join(doubt, "value", "left").select("context", "value", F.when(F.col("seed") == 1, 1.0).otherwise(1.0 - F.exp(F.coalesce("doubt", F.lit(0.0)))).alias("belief"), "seed"))
    return patterns.select("context")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, a count of each kind, base_sha256, spans, n_found."""
    scanned = settle(scan(docs))
    patterns = trusted_patterns(scanned)
    seen = scanned.select("place", F.explode("candidates").alias("x")).select("place", "x.*").join(patterns, "context", "left_semi")
    # a document's own spans; a list of them is no longer than its text
    more = seen.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("more"))
    rows = scanned.join(more, "place", "left")
    extra = F.transform(F.coalesce("more", F.array().cast("array<struct<start:long,end:long>>")), lambda s: F.struct(F.lit(FOUND).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return rows.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.concat(base, extra)).alias("spans"), F.size(extra).cast("long").alias("n_found")
    )
