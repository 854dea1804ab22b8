import random

import brute
import numpy as np
import pytest

from trastienda.llm import forest, setjoin


def word_sets(texts, size=4):
    found = []
    for text in texts:
        words = brute.WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        found.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set())
    return found


def brute_components(sets, percent=80):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if label[i] != label[j] and both and 100 * both >= percent * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def edited(rng, words, share):
    return [w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in words]


def grouped(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    return {r.key: r.component for r in forest.near_duplicates(frame, **options).collect()}


def test_query_against_brute_force(spark, sf, documents):
    from trastienda.llm.registry import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op11_lsh_forest"](spark, sf).collect()}
    sets = word_sets([t for _, t, _, _ in documents])
    for (doc_id, *_), words, label in zip(documents, sets, brute_components(sets), strict=True):
        assert tuple(rows[doc_id]) == (doc_id, len(words), documents[label][0], doc_id == documents[label][0])
    assert sum(not r.kept for r in rows.values()) > 5


def test_borderline_and_chains(spark):
    """Copies edited at many rates, so that pairs lie on both sides of the bound, and chains of copies of copies."""
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(6, 260))]
        texts += [" ".join(edited(rng, words, share)) for share in (0, 0.01, 0.02, 0.04, 0.05, 0.06, 0.08)]
        for _ in range(6):
            words = edited(rng, words, 0.02)
            texts.append(" ".join(words))
    rng.shuffle(texts)
    label = brute_components(word_sets(texts))
    assert grouped(spark, texts) == dict(enumerate(label))
    assert 20 < len(set(label)) < len(texts)


@pytest.mark.parametrize("region, block", [(256, 1024), (4, 8)])
def test_a_dense_group_and_a_shared_passage(spark, monkeypatch, region, block):
    """A third of the rows are copies of one text with edits, others share a long passage without being copies."""
    monkeypatch.setattr(setjoin, "REGION", region)
    monkeypatch.setattr(setjoin, "BLOCK", block)
    rng = random.Random(9)
    base = [f"b{rng.randrange(500)}" for _ in range(120)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [" ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.03]))) for _ in range(80)]
    texts += [passage + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(60)]
    texts += [" ".join(f"y{rng.randrange(10**6)}" for _ in range(30)) for _ in range(60)]
    rng.shuffle(texts)
    assert grouped(spark, texts) == dict(enumerate(brute_components(word_sets(texts))))


def test_neighbours_across_ranges(spark):
    """However the order is cut into ranges, each two neighbours that share parts are found."""
    rng = random.Random(10)
    rows = [(g, tree, rng.randrange(4) << 48 | rng.randrange(3) << 32 | rng.randrange(2) << 16, 5) for g in range(400) for tree in range(3)]
    found = {(r.a, r.b) for r in setjoin.neighbours(spark.createDataFrame(rows, "g long, tree long, label long, n long").repartition(7)).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2], r[3], r[0]))
    expected = {(x[0], y[0]) for x, y in zip(order, order[1:], strict=False) if x[1] == y[1] and x[2] >> 32 == y[2] >> 32}
    assert found == expected


def test_minima_tell_the_similarity():
    rng = np.random.default_rng(3)
    by = forest.seeds(forest.TREES * setjoin.PARTS)
    shares = []
    for _ in range(200):
        both, one, two = (rng.integers(0, 1 << 63, n).astype("u8") for n in (80, 10, 10))
        x, y = (forest.labels(np.concatenate([both, own]), by).view("u2") for own in (one, two))
        shares.append((x == y).mean())
    assert abs(np.mean(shares) - 0.8) < 0.01 and np.std(shares) < 0.07
    long = rng.integers(0, 1 << 63, 3000).astype("u8")
    assert (forest.labels(long, by) == forest.labels(long[::-1].copy(), by)).all()


def test_odd_and_no_rows(odd, nothing, odd_rows):
    rows = forest.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    by = {(r.key, r.n_shingles): r.component for r in rows}
    assert by[1, 1] == by[2, 1] == by[None, 1] == 1 and by[3, 0] == 3 and by[4, 0] == 4 and by[5, 0] == 5 and by[None, 0] is None
    assert by[6, 2] == 6 and by[7, 1] == 7
    assert forest.near_duplicates(nothing).count() == 0
