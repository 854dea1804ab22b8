import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trastienda.llm import rarejoin, setjoin, simhash, trie
from trastienda.llm.components import components


def families(seed, groups=40, most=25):
    """Fingerprints in families, chains of which are one to four bits apart."""
    rng = random.Random(seed)
    found = [0, (1 << 64) - 1, 1 << 63]
    for _ in range(groups):
        now = rng.getrandbits(64)
        for _ in range(rng.randrange(1, most)):
            found.append(now)
            for _ in range(rng.randrange(1, 5)):
                now ^= 1 << rng.randrange(64)
    return sorted(set(found))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("node_rows", [2, 10, 2000])
def test_trie_join_finds_every_component(spark, node_rows):
    prints = families(node_rows)
    distinct = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    label = {r.node: r.root for r in components(simhash.links(distinct, node_rows)).collect()}
    mine = [label.get(signed(p), signed(p)) for p in prints]
    theirs = brute.components(prints)
    assert len(set(zip(mine, theirs, strict=True))) == len(set(mine)) == len(set(theirs))


def test_one_dense_family(spark):
    """A third of all rows in one family: its nodes are split, and no link is lost."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    family = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(3))) for _ in range(1500)}
    prints = sorted(family | {rng.getrandbits(64) for _ in range(3000)})
    distinct = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    label = components(simhash.links(distinct, 100))
    assert label.groupBy("root").count().agg(F.max("count")).first()[0] >= len(family) - 1


def test_links_are_within_the_budget(spark):
    prints = families(3)
    for a, b in simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), 5).collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2


def test_fingerprints(documents, odd_rows):
    for text in [t for _, t, _, _ in documents[:120]] + [r[1] for r in odd_rows if len(r[1] or "") < 1000]:
        assert simhash.fingerprint(text or "") == brute.fingerprint(text)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole == brute.fingerprint(text)


def test_odd_rows(odd, nothing, odd_rows):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    by = {}
    for r in rows:
        by.setdefault(r.fingerprint, set()).add(r.component)
    assert all(len(c) == 1 for c in by.values())
    assert by["0" * 16] == {3}
    assert {r.component for r in rows if r.key in (1, 2)} == {1}
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len({r.component for r in rows})
    assert simhash.drop_near_copies(nothing).count() == 0


def test_query_against_brute_force(spark, sf, documents):
    from trastienda.llm.registry import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op7_simhash_trie"](spark, sf).collect()}
    prints = [brute.fingerprint(t) for _, t, _, _ in documents]
    for (doc_id, *_), print_, label in zip(documents, prints, brute.components(prints), strict=True):
        assert rows[doc_id].fingerprint == f"{print_:016x}"
        assert rows[doc_id].component_id == documents[label][0]


def test_near_copies_of_the_stage(spark, monkeypatch):
    """Five words, similarity 0.8: a few replaced words are a near copy, whatever the two-bit rule says; more aren't."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]

    def edited(*at):
        return " ".join("edit" + str(k) if k in at else w for k, w in enumerate(words))

    texts = [edited(), edited(*range(20, 300, 60)), edited(*range(10, 300, 20)), edited(40, 140, 240), " ".join(reversed(words))]
    assert brute.near_components(texts) == [0, 0, 2, 0, 4]
    assert all((simhash.fingerprint(texts[0]) ^ simhash.fingerprint(texts[k])).bit_count() > 2 for k in (1, 3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (256, 1):
        monkeypatch.setattr(setjoin, "BLOCK", block)
        assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == [0, 2, 4]


@pytest.mark.parametrize("block", [1024, 5])
def test_groups_of_every_similarity(spark, monkeypatch, block):
    """Families around a similarity of 0.8, short texts, and a passage that all texts share, against all pairs."""
    rng = random.Random(block)
    passage = [f"p{k}" for k in range(30)]
    texts = ["", " ", "one two", "one two", "One Two"]
    for family in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 150))]
        for _ in range(rng.randrange(1, 12)):
            now = [f"x{rng.randrange(9)}" if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else w for w in words]
            texts.append(" ".join(now + passage * (family % 2)))
    rng.shuffle(texts)
    monkeypatch.setattr(setjoin, "BLOCK", block)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    label = brute.near_components(texts)
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == [k for k in range(len(texts)) if label[k] == k]


@pytest.mark.parametrize("counts", [np.zeros(1 << rarejoin.SLOT_BITS, "i8"), np.arange(1 << rarejoin.SLOT_BITS) % 7])
def test_similar_sets_are_posted_together(counts):
    rng = np.random.default_rng(3)
    for _ in range(300):
        left = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 60)).astype("u8"))
        right = np.unique(np.concatenate([rng.permutation(left)[: rng.integers(0, len(left) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 12)).astype("u8")]))
        if len(right) and 100 * len(np.intersect1d(left, right)) >= 80 * len(np.union1d(left, right)):
            assert len(np.intersect1d(rarejoin.rarest(left, counts), rarejoin.rarest(right, counts)))


def test_survivors_are_the_rows_with_candidates():
    rng = np.random.default_rng(5)
    rows = []
    for region in range(60):
        high = int(rng.integers(0, 2))
        base = rng.integers(0, 1 << 62, rarejoin.FP_WORDS)
        part = [[0, region, 0, high, int(rng.integers(0, 4)), g, int(rng.integers(5, 9)), int(rng.integers(0, high + 1))] for g in range(int(rng.integers(1, 9)))]
        for row in sorted(part, key=lambda r: (r[4], r[5])):
            fp = np.where(rng.random(rarejoin.FP_WORDS) < 0.5, base, base ^ rng.integers(0, 1 << 62, rarejoin.FP_WORDS))
            rows.append((row, np.concatenate([fp, np.unique(rng.integers(0, 30, rng.integers(0, rarejoin.TOLD)))]).astype("i8")))
    names = setjoin.ROW
    table = pa.table({**{c: pa.array([r[0][k] for r in rows], pa.int64()) for k, c in enumerate(names)}, "labels": pa.array([r[1] for r in rows], pa.list_(pa.int64()))})
    expected = []
    for part in setjoin.by_region(iter(table.to_batches(max_chunksize=17))):
        marks = [np.array(x) for x in part.column("labels").to_pylist()]
        expected += rarejoin.Shared(np.stack([part.column(c).to_numpy() for c in names]), marks, 80, rarejoin.BUDGET).surviving().tolist()
    got = [x for whole in rarejoin.whole_regions(iter(table.to_batches(max_chunksize=17))) for x in rarejoin.surviving(whole, 80, rarejoin.BUDGET).tolist()]
    assert got == expected and 10 < sum(got) < len(got) - 10


@pytest.mark.parametrize("parts", [1, 7])
def test_meetings_keep_all_that_share_a_shingle(spark, parts):
    rng = random.Random(parts)
    rows = [(g, rng.randrange(1, 9), rng.sample(range(60), 3) + [1000 + g]) for g in range(80)] + [(80 + k, 1, [999]) for k in range(50)]
    nodes = spark.createDataFrame(rows, "g long, n long, rare array<long>")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for k, v in zip(before, (str(parts), "false", "4"), strict=True):
        spark.conf.set(k, v)
    try:
        found = rarejoin.meetings(nodes).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    under = {}
    for g, _, rare in rows:
        for s in rare:
            under.setdefault(s, set()).add(g)
    got = {}
    for r in found:
        got.setdefault(r.shingle, []).append(r.g)
        assert r.before < 0 or r.before in under[r.shingle] and r.before != r.g
    assert all(sorted(got[s]) == sorted(gs) for s, gs in under.items() if len(gs) > 1)
    assert sum(len(gs) == 1 for s, gs in under.items() if s in got) <= 2 * parts
    assert sum(r.before >= 0 for r in found) >= sum(len(gs) - 1 for gs in under.values()) - 2 * parts


def test_stage_against_brute_force(spark, sf, documents):
    """All pairs of documents, by their sets of five-word shingles."""
    label = brute.near_components([t for _, t, _, _ in documents])
    kept = simhash.drop_near_copies(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [d[0] for k, d in enumerate(documents) if label[k] == k]


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 49)], [(3, 3)]])
def test_components(spark, edges):
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == {n: r for n, r in label.items() if n != r}


def test_numpy_traversal():
    rng = np.random.default_rng(1)
    a, b = (np.sort(rng.integers(0, 1 << 14, 400).astype("u8")) for _ in range(2))
    found = {(int(i), int(j)) for x, y in simhash.linked(a, b, 0, 14) for i, j in zip(x, y, strict=True)}
    assert found == {(i, j) for i in range(400) for j in range(400) if (int(a[i]) ^ int(b[j])).bit_count() <= 2}


@pytest.mark.parametrize("leaf", [1, 8, 4096])
def test_many_tries_of_long_fingerprints_at_once(leaf):
    """Tries that meet themselves or another one give the pairs within the budget, each once."""
    rng = np.random.default_rng(leaf)
    group = np.sort(rng.integers(0, 12, 300))
    base = rng.integers(0, 1 << 63, (12, 4)).astype("u8")
    noise = np.bitwise_and.reduce(rng.integers(0, 1 << 63, (3, 300, 4)), axis=0).astype("u8")
    fp = base[group] ^ np.where(rng.random((300, 1)) < 0.1, np.uint64(0), noise)
    fp = fp[trie.order(fp, group)]
    begin, end = (np.searchsorted(group, np.arange(12), side) for side in ("left", "right"))
    even = lambda i, j: (i + j) % 2 == 0
    near = lambda i, j: np.bitwise_count(fp[i] ^ fp[j]).sum() <= 48 and even(i, j)
    got = [(int(a), int(b)) for i, j in trie.linked(fp, (begin, end), (begin, end), 48, even, leaf, 50) for a, b in zip(i, j, strict=True)]
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if group[i] == group[j] and near(i, j)}
    assert len(got) == len(set(got)) and {tuple(sorted(x)) for x in got} == want and len(want) > 100
    apart = [(int(a), int(b)) for i, j in trie.linked(fp, (begin[:-1], end[:-1]), (begin[1:], end[1:]), 128, even, leaf, 50) for a, b in zip(i, j, strict=True)]
    assert sorted(apart) == [(i, j) for i in range(300) for j in range(300) if group[i] + 1 == group[j] and np.bitwise_count(fp[i] ^ fp[j]).sum() <= 128 and even(i, j)]


@pytest.mark.parametrize("leaf", [1, 4096])
def test_pairs_of_blocks_are_joined_along_the_trie(leaf):
    """The rows that the traversal leaves are those with a candidate, whether a block meets itself or another, or an empty one."""
    rng = np.random.default_rng(leaf)
    names, rows = setjoin.ROW, []
    for region in range(30):
        low = int(rng.integers(0, 2))
        high = low + int(rng.integers(0, 2))
        base = rng.integers(0, 1 << 62, rarejoin.FP_WORDS)
        part = [[0, region, low, high, int(rng.integers(0, 5)), g, 10, int(rng.integers(low, high + 1))] for g in range(int(rng.integers(1, 30)))]
        for row in sorted(part, key=lambda r: (r[4], r[5])):
            rows.append((row, np.where(rng.random(rarejoin.FP_WORDS) < 0.5, base, rng.integers(0, 1 << 62, rarejoin.FP_WORDS)).astype("i8")))
    table = pa.table({**{c: pa.array([r[0][k] for r in rows], pa.int64()) for k, c in enumerate(names)}, "labels": pa.array([r[1] for r in rows], pa.list_(pa.int64()))})
    expected = [
        any(
            a[:4] == b[:4] and a[4] != b[4] and (a[2] == a[3] or a[7] != b[7]) and np.bitwise_count(x.view("u8") ^ y.view("u8")).sum() <= rarejoin.BUDGET
            for b, y in rows
        )
        for a, x in rows
    ]
    assert rarejoin.surviving(table, 80, rarejoin.BUDGET, leaf).tolist() == expected and 10 < sum(expected) < len(rows) - 10
