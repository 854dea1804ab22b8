import random
import re
import zlib
from hashlib import sha256

import brute
import numpy as np
import pytest

from trastienda.llm import periods


def brute_lyndon(s):
    def longest(i):
        return max(k for k in range(1, len(s) - i + 1) if all(s[i : i + k] < s[j : i + k] for j in range(i + 1, i + k)))

    return [longest(i) for i in range(len(s))]


def brute_runs(s, repeats=4, least=6):
    """By definition: maximal stretches with period q, of which q is the smallest period."""
    found = []
    for q in range(1, len(s) // repeats + 1):
        i = 0
        while i < len(s) - q:
            j = i
            while j < len(s) - q and s[j] == s[j + q]:
                j += 1
            word = s[i : j + q]
            if len(word) >= max(least, repeats * q) and not any(word[r:] == word[:-r] for r in range(1, q)):
                found.append((i, len(word), q))
            i = max(j, i + 1)
    return sorted(found)


def texts(rng, count, most):
    for _ in range(count):
        n, k = rng.randrange(most), rng.choice([1, 2, 3, 5, 40])
        s = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(3) if n else 0):
            a, p = rng.randrange(n), rng.randrange(1, 12)
            for i in range(a + p, min(n, a + rng.randrange(1, 70))):
                s[i] = s[i - p]
        yield s


def test_grouping_gives_the_lyndon_array():
    for s in texts(random.Random(2), 400, 24):
        assert periods.lyndon_array(np.array(s, "i8")) == brute_lyndon(s)


@pytest.mark.parametrize("repeats", [2, 3, 4, 6])
def test_runs_against_their_definition(repeats):
    for s in texts(random.Random(repeats), 400, 90):
        assert periods.runs(np.array(s, "i8"), repeats) == brute_runs(s, repeats)


def test_stretches_hold_every_run():
    rng = random.Random(4)
    for _ in range(12):
        p, n = rng.randrange(1, 120), 700
        s = [rng.randrange(2000) for _ in range(n)]
        a = rng.randrange(n - 4 * p if n > 4 * p else 1)
        for i in range(a + p, min(n, a + 4 * p + rng.randrange(p + 6))):
            s[i] = s[i - p]
        for start, length, _ in brute_runs(s):
            assert any(x <= start and start + length <= y for x, y in periods.stretches(np.array(s)))


def test_one_long_run():
    ids = np.tile(np.arange(700), 150)
    assert periods.runs(ids) == [(0, 105_000, 700)]
    assert periods.runs(np.zeros(50_000, "i8")) == [(0, 50_000, 1)]


def expected(doc_id, text):
    words = brute.WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if n and doc_id is not None and h % 10 == 0:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    drop = {i for start, length, q in found for i in range(start + q, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *top, sha256(listed.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def test_query_against_brute_force(spark, sf, documents):
    from trastienda.llm.registry import QUERIES

    rows = sorted(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf).collect())
    theirs = sorted(expected(d, t) for d, t, _, _ in documents if len((t or "").split()) < 400)
    ids = {r[0] for r in theirs}
    assert [r for r in rows if r[0] in ids] == theirs and len(rows) == len(documents)
    assert sum(r[1] > 0 for r in theirs) > 2


def test_odd_and_no_rows(odd, nothing, odd_rows):
    rows = periods.period_runs(odd, alter=True, with_text=True).collect()
    assert len(rows) == len(odd_rows)
    long = next(r for r in rows if r.key == 6)
    assert (long.start, long.length, long.period, long.collapsed) == (0, 60_000, 2, "übermäßig lang")
    assert all(r.n_runs == 0 and r.start is None for r in rows if r.key != 6)
    empty = sha256(b"").hexdigest()
    assert all(r.runs_sha256 == r.collapsed_sha256 == empty for r in rows if r.key in (3, 4, 5))
    assert periods.period_runs(nothing).count() == 0


def test_collapsed_text_is_a_part_of_the_text(spark):
    text = "a b c " + "x y " * 5 + "tail"
    row = periods.period_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), with_text=True).first()
    assert row.collapsed == "a b c x y tail" and [tuple(r) for r in row.runs] == [(3, 10, 2)]
    assert re.sub(r"(x y ?)+", "x y ", text) == row.collapsed
