"""Secrets by rules, found through an inverted index of trigrams.

Each rule is a regular expression. From its syntax tree follows what a match must contain: a
conjunction of clauses, each a choice of strings, each string the set of its trigrams. The index
has a posting (trigram, document) for every trigram of these queries. Postings of a choice are
intersected, clauses are too, and only the documents left are verified with the rule
itself. A rule without a mandatory trigram is tried on every document.

Main path: DataFrame functions only. The syntax trees of the few rules are read on the driver.

Defined cases: null text is empty text and has no spans; repeated rows are documents of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import located, text_of
from trastienda.llm.spans import joined, spans


class Rule(NamedTuple):
    name: str
    pattern: str
    #: The group that must have `least` characters, or the match is dropped.
    group: int = 0
    least: int = 0


# The three base rules.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Published formats of keys.
FURTHER = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
)
RULES = BASE + FURTHER
#: Strings that a run of the pattern may unfold to.
UNFOLD = 64

Clause = list[frozenset[str]]


def _strings(node: tuple[Any, Any]) -> set[str] | None:
    """All strings that a part of the pattern stands for, if they are few."""
    kind, value = str(node[0]), node[1]
    if kind == "LITERAL":
        return {chr(value).lower()}
    if kind == "IN":
        found: set[str] = set()
        for inner, x in value:
            if str(inner) == "LITERAL":
                found.add(chr(x).lower())
            elif str(inner) == "RANGE" and x[1] - x[0] < 8:
                found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return found
    if kind == "SUBPATTERN":
        return _run(value[3])
    if kind == "BRANCH":
        parts = [_run(x) for x in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if kind == "MAX_REPEAT" and value[1] != re._constants.MAXREPEAT and value[1] <= 3:
        inner_strings = _run(value[2])
        if inner_strings is None:
            return None
        found, now = set(), {""}
        for n in range(value[1] + 1):
            found |= now if n >= value[0] else set()
            now = {a + b for a in now for b in inner_strings}
        return found
    return None


def _run(nodes: Iterable[tuple[Any, Any]]) -> set[str] | None:
    found = {""}
    for node in nodes:
        part = _strings(node)
        if part is None or len(found) * len(part) > UNFOLD:
            return None
        found = {a + b for a in found for b in part}
    return found


def _trigrams(strings: set[str]) -> Clause | None:
    """What one of the strings being there implies; None if nothing."""
    if any(len(s) < 3 for s in strings):
        return None
    choices = {frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in strings}
    return sorted((c for c in choices if not any(d < c for d in choices)), key=sorted)


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold where the pattern matches, in lower case; none if it has no mandatory trigram."""
    clauses: list[Clause] = []

    def walk(nodes: Iterable[tuple[Any, Any]]) -> None:
        run = {""}

        def close() -> None:
            clause = _trigrams(run)
            if clause:
                clauses.append(clause)

        for node in nodes:
            part = _strings(node)
            if part is not None and len(run) * len(part) <= UNFOLD:
                run = {a + b for a in run for b in part}
                continue
            close()
            run = part if part is not None else {""}
            kind, value = str(node[0]), node[1]
            if part is None and kind == "SUBPATTERN":
                walk(value[3])
            elif part is None and kind == "MAX_REPEAT" and value[0] >= 1:
                walk(value[2])
        close()

    walk(re._parser.parse(pattern))
    return clauses


def postings(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(trigram, key): a row for each trigram of the rules' queries that a document has, from (key, text)."""
    wanted = sorted({t for rule in rules for clause in trigram_query(rule.pattern) for choice in clause for t in choice})
    folded = docs.select("key", F.lower("text").alias("text"))
    there = F.array_compact(F.array(*[F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in wanted]))
    return folded.select("key", F.explode(there).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(key, rules): the rules whose queries a document satisfies."""
    rows, clauses = [], {}
    for rule in rules:
        for c, clause in enumerate(trigram_query(rule.pattern)):
            clauses[rule.name] = c + 1
            rows += [(t, rule.name, c, k, len(choice)) for k, choice in enumerate(clause) for t in sorted(choice)]
    spark = index.sparkSession
    if not rows:
        return spark.createDataFrame([], f"key {index.schema['key'].dataType.simpleString()}, rules array<string>")
    # bounded by the rules, not by the data
    query = F.broadcast(spark.createDataFrame(rows, "trigram string, rule string, clause int, choice int, needs int"))
    met = index.join(query, "trigram").groupBy("key", "rule", "clause", "choice", "needs").agg(F.count("*").alias("has")).where("has >= needs")
    number = F.create_map(*[F.lit(x) for item in clauses.items() for x in item])
    whole = met.groupBy("key", "rule").agg(F.count_distinct("clause").alias("met")).where(F.col("met") == number[F.col("rule")])
    return whole.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _named(k: int, rule: Rule, found: Column) -> Column:
    enough = F.filter(found, lambda s: F.length(s["value"]) >= rule.least)
    return F.transform(enough, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rule"), s["end"].alias("end"), F.lit(rule.name).alias("kind")))


def _count(name: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == name)).cast("long")


def secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, base spans and all spans (kind, start, end), by start and then by rule."""
    # rows whose keys agree by chance only share their candidates, which the rules verify
    rows = located(docs, [F.col("doc_id"), text_of().alias("text")]).select(F.xxhash64("place").alias("key"), "doc_id", "text")
    rows = rows.join(candidates(postings(rows, rules), rules), "key", "left")
    text, parts = F.col("text"), []
    for k, rule in enumerate(rules):
        tried = F.coalesce(F.array_contains("rules", rule.name), F.lit(False)) if trigram_query(rule.pattern) else F.lit(True)
        parts.append(_named(k, rule, spans(text, rule.pattern, rule.group, tried)))
    rows = rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("all"))
    base = F.filter("all", lambda s: s["rule"] < len(BASE))
    return rows.select("doc_id", base.alias("base"), "all")


def digest(found: DataFrame) -> DataFrame:
    counts = [_count(rule.name).alias(f"n_{rule.name}") for rule in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))
