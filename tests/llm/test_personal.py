import hashlib

import brute
import pytest
from pyspark.sql import functions as F

from trastienda.llm import personal
from trastienda.llm.registry import QUERIES
from trastienda.llm.spans import spans

TRICKY = [
    "a@b.c_d@e.f-g.h a@b @x.y a.@-.- x%y@q.w.e.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.1 1.2.3 9.9.9.9999 1.2.3.4@5.6",
    "4111 1111 1111 1111-4111111111111111 4111-1111  1111 0000000000000 12345678901234567890123",
    "+1 (017) 555-7713+49 30 123456789 ++12 +1((((( +1 2 +123456789012345678",
    "éé🙂 call +1 (017) 555-7713 ü mail x@y.zz 🙂 1.1.1.1",
    "a" * 30_000,
    "1" * 30_000,
    "1 " * 20_000,
    "a@" * 5_000 + "b.c",
    "." * 20_000 + "@x.y",
]


def check(rows, texts):
    for r in rows:
        mine = brute.personal(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(mine.encode()).hexdigest()
        assert r.spans.startswith(mine)
        for kind in personal.KINDS:
            assert r[f"n_{kind}"] == sum(x.startswith(f"{kind}:") for x in mine.split(","))


def test_query_against_brute_force(spark, sf, documents):
    rows = QUERIES["op9_personal_data"](spark, sf).collect()
    assert len(rows) == len(documents)
    check(rows, {d: t for d, t, _, _ in documents})


def test_tricky_texts(spark):
    rows = personal.personal_data(spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")).collect()
    assert len(rows) == len(TRICKY)
    check(rows, dict(enumerate(TRICKY)))


def test_contexts_discover_identifiers(spark):
    rows = [(k, f"Some text. Write to contact me: user{k}@mail{k}.example.com for more.") for k in range(8)]
    rows += [(100, "Please contact me: K-4471-90922 or so."), (101, "In 2014 there were 1234567 of them."), (102, "Contact me: K-0000-12345, contact me: x")]
    found = {r.doc_id: r for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d for d, r in found.items() if r.n_found} == {100, 102}
    start = rows[8][1].index("K-")
    assert found[100].spans == f"found:{start}:{start + 12}"


def test_mixed_contexts_are_not_trusted(spark):
    rows = [(k, f"number is u{k}@m{k}.org here") for k in range(6)] + [(50 + k, f"number is {10**6 + k} here") for k in range(6)]
    found = personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.agg(F.sum("n_found")).first()[0] == 0


def test_odd_rows(odd, nothing, odd_rows):
    rows = personal.personal_data(odd).collect()
    assert len(rows) == len(odd_rows) and all(r.spans == "" for r in rows)
    assert personal.personal_data(nothing).count() == 0


@pytest.mark.parametrize("text", ["", "1", "a1b22c", "é1🙂2", "9 " * 1000, "x"])
def test_spans(spark, text):
    frame = spark.createDataFrame([(text,)], "t string").select(spans(F.col("t"), "[0-9]+").alias("s"))
    import re

    assert [(s.start, s.end, s.value) for s in frame.first().s] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]
