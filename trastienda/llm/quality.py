"""Quality rules whose cutoffs control the risk of rejecting good documents.

Every rule is a number of a document that is larger the worse the document is, and a cutoff.
The labelled rows are split in two. On the tuning rows each rule of each stratum (language) gets
the cutoff of a fixed grid that is worth most: bad documents that it rejects, less a price for
each good one; where none is worth anything, the rule doesn't apply. A stratum's rules are ordered by worth.
The other rows, which took no part in that, are the holdouts. There the verdict is tested, first with
the best rule alone, then with the next one added, until a test fails: is the part of good
documents that any of these rules rejects at most `risk`? The test is the exact binomial one,
which is the same as asking whether the Clopper-Pearson bound is at most `risk`. A fixed sequence needs
no correction within a stratum; the level is shared out over the strata (Bonferroni). So with
probability 1 - `level` the verdict rejects in no stratum more good documents than promised,
among those that pass the base rules.

Defined cases: null text has no words and fails the base rules; documents of a stratum without
enough labels are only held to the base rules; null strata are a stratum of their own;
repeated rows count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trastienda.llm.common import WORD, text_of

RISK, LEVEL = 0.02, 0.05
#: Bad documents that a cutoff must reject for each good one.
PRICE = 5
#: Cutoffs of every rule from loose to strict, as parts; a document is beyond one if its value is larger.
GRID = tuple(round(x / 200, 3) for x in range(199, 0, -1))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = re.compile(r"[#*$%&|<>]")
_WORD = re.compile(WORD)


def base_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """The base counts and the number of lines that have a word."""
    words = _WORD.findall(text)
    n = len(words)
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    found = Counter(windows)
    repeat = 0
    if len(found) < len(windows):
        covered = 0
        for k, window in enumerate(windows):
            if found[window] > 1:
                repeat += k + 3 - max(k, covered)
                covered = k + 3
    return n, sum(map(len, words)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeat, len(lines)


def counted(docs: DataFrame, carry: Column) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of each whole text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [base_counts(text.as_py()) for text in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["key", *BASE, "n_lines"])

    source = docs.select(carry.alias("key"), text_of().alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(scan, f"key {kind}, {', '.join(f'{c} long' for c in BASE)}, n_lines long")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    """The rules' values, 0 to 1."""
    part = lambda a, b: F.when(b > 0, F.least(a / b, F.lit(1.0))).otherwise(0.0)
    mean = part(F.col("word_chars"), 20 * F.col("n_words"))
    return {
        "symbols": part(F.col("n_symbols"), F.col("word_chars")),
        "dup_lines": part(F.col("n_dup_lines"), F.col("n_lines")),
        "repeats": part(F.col("n_repeat_words"), F.col("n_words")),
        "long_words": mean,
        "short_words": F.when(F.col("n_words") > 0, 1.0 - mean).otherwise(0.0),
    }


def binomial_below(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n trials."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def most_useful(good: list[int], bad: list[int]) -> tuple[int, int] | None:
    """(worth, position in the grid) of the best cutoff; good[i] good documents and bad[i] bad ones are beyond it."""
    worth, position = max(((gain - PRICE * k, -position) for position, (k, gain) in enumerate(zip(good, bad, strict=True))), default=(0, 0))
    return (worth, -position) if worth > 0 else None


def certified(lost: list[int], n: int, risk: float, level: float) -> int:
    """How many rules of a sequence hold the risk together; lost[i] of n good holdouts are rejected by the first i + 1."""
    for position, k in enumerate(lost):
        if k > risk * n or binomial_below(k, n, risk) > level:
            return position
    return len(lost)


def tuned(rows: DataFrame) -> dict[str | None, list[tuple[str, float]]]:
    """For each stratum its rules with the most useful cutoffs, the best first."""
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), value.alias("value")) for name, value in rule_values().items()])).alias("r")
    # the number of cutoffs that the value is beyond, the strictest first
    step = F.least(F.greatest((F.ceil(F.col("r.value") * 200) - 1).cast("int"), F.lit(0)), F.lit(len(GRID)))
    counts = rows.select("stratum", "good", rules).groupBy("stratum", "r.rule", "good", step.alias("step")).agg(F.count("*").alias("n")).collect()
    tables: dict[tuple[str | None, str], dict[bool, Counter]] = {}
    for row in counts:
        tables.setdefault((row["stratum"], row["rule"]), {True: Counter(), False: Counter()})[row["good"]][row["step"]] += row["n"]
    found: dict[str | None, list[tuple[int, str, float]]] = {}
    for (stratum, rule), sides in tables.items():
        good, bad = ([sum(c for step, c in sides[side].items() if step >= len(GRID) - position) for position in range(len(GRID))] for side in (True, False))
        if best := most_useful(good, bad):
            found.setdefault(stratum, []).append((-best[0], rule, GRID[best[1]]))
    return {stratum: [(rule, cutoff) for _, rule, cutoff in sorted(rules)] for stratum, rules in found.items()}


def learn(labelled: DataFrame, tuning: Column, risk: float = RISK, level: float = LEVEL) -> dict[tuple[str | None, str], float]:
    """Cutoffs by (stratum, rule), from rows with the base counts, `stratum` and `good`.

    Rows where `tuning` holds choose the cutoffs, the others test them. What reaches the driver is
    a count for each stratum, rule and cutoff of the grid.
    """
    rows = labelled.withColumn("_tuning", tuning).where(~base_failed() & F.col("good").isNotNull())
    chosen = tuned(rows.where("_tuning"))
    if not chosen:
        return {}
    values = rule_values()
    first = [
        F.when(F.col("stratum").eqNullSafe(F.lit(stratum)) & (values[rule] > F.lit(cutoff)), F.lit(position))
        for stratum, rules in chosen.items()
        for position, (rule, cutoff) in enumerate(rules)
    ]
    tested = rows.where("good AND NOT _tuning").groupBy("stratum", F.array_min(F.array_compact(F.array(*first))).alias("first")).agg(F.count("*").alias("n")).collect()
    cutoffs = {}
    for stratum, rules in chosen.items():
        counts = Counter({row["first"]: row["n"] for row in tested if row["stratum"] == stratum})
        lost = [sum(counts[k] for k in range(position + 1)) for position in range(len(rules))]
        cutoffs.update({(stratum, rule): cutoff for rule, cutoff in rules[: certified(lost, counts.total(), risk, level / len(chosen))]})
    return cutoffs


def judged(rows: DataFrame, cutoffs: dict[tuple[str | None, str], float]) -> DataFrame:
    """Adds base_failed, `failed` (the rules beyond their cutoff) and kept."""
    values = rule_values()
    failed = [
        F.when(F.col("stratum").eqNullSafe(stratum) & (values[rule] > F.lit(cutoff)), F.lit(rule))
        for (stratum, rule), cutoff in sorted(cutoffs.items(), key=lambda x: (x[0][0] is not None, x[0][0] or "", x[0][1]))
    ]
    rows = rows.withColumn("base_failed", base_failed()).withColumn("failed", F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
