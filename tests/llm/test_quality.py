import math
import zlib

import brute
import pytest
from pyspark.sql import functions as F

from trastienda.llm import quality
from trastienda.llm.registry import QUERIES


def test_query_against_brute_force(spark, sf, documents):
    rows = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, sf).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, _, _ in documents:
        r = rows[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a", "x\nx\n\n \nx", "a b c d b c d a b c", "#$ %&|<> *", "ä ö ü"])
def test_base_counts(text):
    assert quality.base_counts(text)[:5] == brute.quality(text)


def test_binomial_is_exact():
    for n, p in ((1, 0.5), (20, 0.02), (50, 0.3)):
        for k in range(n + 1):
            exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert quality.binomial_below(k, n, p) == pytest.approx(exact)


def test_choice_of_a_cutoff():
    assert quality.most_useful([0, 0], [3, 9]) == (9, 1)
    # the looser one of equals, and none that is worth nothing
    assert quality.most_useful([0, 0, 1], [9, 9, 14]) == (9, 0)
    assert quality.most_useful([0, 2], [0, 9]) is None and quality.most_useful([], []) is None


def test_rules_are_added_while_the_verdict_holds():
    # at 2 % and 5 %, 149 good documents without a loss are needed
    assert quality.certified([0, 0], 149, 0.02, 0.05) == 2 and quality.certified([0, 0], 148, 0.02, 0.05) == 0
    # stops at the first failure, whatever comes after
    assert quality.certified([0, 1, 9, 9], 300, 0.02, 0.05) == 2
    assert quality.certified([], 0, 0.02, 0.05) == 0 and quality.certified([0], 0, 0.02, 0.05) == 0


COLUMNS = "k long, stratum string, good boolean, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def test_learned_cutoffs_hold_the_risk(spark):
    rows = [(k, "en", k % 3 > 0, 100, 500, 200 if k % 3 == 0 else k % 4, 0, 0, 5) for k in range(3000)] + [(0, None, True, 100, 500, 0, 0, 0, 5)] * 10
    frame = spark.createDataFrame(rows, COLUMNS)
    cutoffs = quality.learn(frame, F.col("k") % 5 == 1)
    assert set(cutoffs) == {("en", "symbols")} and 0 < cutoffs["en", "symbols"] < 0.4
    judged = quality.judged(frame, cutoffs)
    assert judged.where("good AND NOT kept").count() == 0 and judged.where("NOT good AND kept").count() == 0


def test_the_limit_holds_for_all_rules_together(spark):
    """Two rules, each of which rejects 1.2 % other good holdouts: one alone may, both together may not."""
    def row(k):
        good, tuning = k % 2 == 0, k % 5 == 1
        odd = good and not tuning and k // 2 % 80
        symbols = 200 if not good or odd == 1 else 0
        lines = 4 if (not good and k % 4 == 1) or odd == 2 else 0
        return k, None, good, 100, 500, symbols if lines == 0 or good else 0, lines, 0, 5

    frame = spark.createDataFrame([row(k) for k in range(20_000)], COLUMNS)
    tune = F.col("k") % 5 == 1
    holdouts = frame.where(~tune & F.col("good"))
    assert set(quality.learn(frame, tune, risk=0.04)) == {(None, "symbols"), (None, "dup_lines")}
    cutoffs = quality.learn(frame, tune, risk=0.02)
    assert len(cutoffs) == 1
    lost = quality.judged(holdouts, cutoffs).where("NOT kept").count()
    assert 0 < lost <= 0.02 * holdouts.count()


def test_verdict_and_cutoffs_against_brute_force(spark, sf, documents):
    """Cutoffs and verdict of the query, recomputed row by row; no row of the held-out fold is learnt from."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality is not None}
    rows = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, sf).collect()}
    part = lambda a, b: min(a / b, 1.0) if b > 0 else 0.0
    folds, facts = {1: [], 2: []}, {}
    for doc_id, text, lang, _ in documents:
        n, chars, symbols, dup, repeat = brute.quality(text)
        lines = sum(bool(quality._WORD.search(x)) for x in (text or "").split("\n"))
        mean = part(chars, 20 * n)
        values = dict(symbols=part(symbols, chars), dup_lines=part(dup, lines), repeats=part(repeat, n), long_words=mean, short_words=1.0 - mean if n else 0.0)
        failed = n < 50 or 100 * repeat > 50 * n
        facts[doc_id] = lang, values, failed
        fold = zlib.crc32(str(doc_id).encode()) % 5
        if doc_id in labels and not failed and fold:
            folds[min(fold, 2)].append((lang, values, labels[doc_id] == 1))
    chosen = {}
    for lang in {x[0] for x in folds[1]}:
        for rule in quality.rule_values():
            worth = [(sum(-quality.PRICE if good else 1 for other, values, good in folds[1] if other == lang and values[rule] > c), c) for c in quality.GRID]
            if max(worth)[0] > 0:
                chosen.setdefault(lang, []).append((-max(worth)[0], rule, max(worth)[1]))
    cutoffs = {}
    for lang, rules in chosen.items():
        good = [values for other, values, good in folds[2] if other == lang and good]
        for k, (_, rule, cutoff) in enumerate(sorted(rules), 1):
            lost = sum(any(values[r] > c for _, r, c in sorted(rules)[:k]) for values in good)
            if not good or quality.binomial_below(lost, len(good), quality.RISK) > quality.LEVEL / len(chosen):
                break
            cutoffs[lang, rule] = cutoff
    for doc_id, (lang, values, failed) in facts.items():
        beyond = sorted(rule for (other, rule), c in cutoffs.items() if other == lang and values[rule] > c)
        assert sorted(filter(None, rows[doc_id].failed_rules.split(","))) == beyond
        assert rows[doc_id].kept == (not failed and not beyond)


def test_odd_rows(odd, nothing, odd_rows):
    rows = quality.counted(odd, F.struct("doc_id", "text")).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(r.key.text)
    empty = quality.counted(nothing, F.col("doc_id"))
    assert empty.count() == 0
    assert quality.learn(empty.withColumns({"stratum": F.lit("x"), "good": F.lit(True)}), F.lit(True)) == {}
    assert quality.judged(empty.withColumn("stratum", F.lit("x")), {}).count() == 0
