import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from trastienda.llm import toxicity
from trastienda.llm.registry import QUERIES


def test_segments_are_all_maximal_ones():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 100 for _ in range(rng.randrange(1, 25))]
        found = toxicity.segments(np.array(scores))
        assert [(a, b) for a, b, _ in found] == brute.segments(scores)
        assert all(total == pytest.approx(sum(scores[a:b])) for a, b, total in found)
    assert toxicity.segments(np.array([])) == [] == toxicity.segments(np.array([-1.0, 0.0]))


def test_held_out_ranking(spark, tmp_path):
    """Passages of planted words among random ones, at any place of short and very long texts."""
    rng = random.Random(11)
    vocabulary = [f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 7 % 26)}word" for k in range(600)]
    docs, labels = [], []
    for doc_id in range(600):
        tokens = [rng.choice(vocabulary) for _ in range(rng.choice([5, 60, 300, 4000]))]
        toxic = doc_id % 4 == 0
        if toxic:
            at = rng.randrange(len(tokens) + 1)
            tokens[at:at] = [rng.choice(["vile", "nasty", "foul"]) for _ in range(rng.randrange(2, 6))]
        docs.append((doc_id, " ".join(tokens)))
        labels.append((doc_id, int(toxic)))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = QUERIES["op5_toxicity"](spark, str(tmp_path)).collect()
    assert len(rows) == 600 and all(r.held_out == brute.held(r.doc_id) for r in rows)
    apart = [r for r in rows if r.held_out]
    assert sum((r.predicted == 1) == (r.doc_id % 4 == 0) for r in apart) >= 0.97 * len(apart)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.n_passages >= 1 for r in rows if r.predicted)


def test_passages_have_places():
    slots = toxicity.Slots()
    docs, tokens = np.zeros((2, toxicity.SLOTS)), np.zeros((2, toxicity.SLOTS))
    for word in ("calm", "plain", "text"):
        docs[0, slots[word]] = 500
        tokens[0, slots[word]] = 5000
    docs[1, slots["foul"]] = tokens[1, slots["foul"]] = 300
    docs[1, slots["calm"]] = tokens[1, slots["calm"]] = 100
    model = toxicity.Model(*toxicity.weigh(docs, tokens), np.zeros(toxicity.STEPS + 1))
    _, passages = toxicity.evidence(slots.of("calm text plain " * 50 + "foul foul foul " + "calm " * 80 + "FOUL foul"), model)
    assert [(a, b) for a, b, _ in passages] == [(150, 153), (233, 235)]


def test_odd_rows(spark, odd, nothing, odd_rows):
    labelled = odd.select("text", F.when(F.col("doc_id") == 2, 1).when(F.col("doc_id") == 3, None).otherwise(0).alias("toxic"))
    for teachers in (labelled, labelled.where("toxic = 0"), labelled.where("toxic = 1"), nothing.select("text", F.lit(1).alias("toxic"))):
        model = toxicity.learn(teachers)
        rows = toxicity.score(odd, model, F.col("doc_id")).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score(nothing, model, F.col("doc_id")).count() == 0


def test_calibration_never_falls():
    chance = toxicity.monotone(np.array([10, 5, 0, 4, 6]), np.array([1, 2, 0, 1, 6]))
    assert list(chance) == pytest.approx([0.1, 1 / 3, 1 / 3, 1 / 3, 1.0])


def test_sample_is_bounded_and_weighed(spark):
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(2000)] + [(None, 1), (5000, None), (5001, 7)], "doc_id long, toxic int")
    chosen, weights = toxicity.sample(labels, rows=64)
    sizes = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    assert set(sizes) == {0, 1} and all(50 <= n <= 64 for n in sizes.values())
    assert {k: round(weights[k] * sizes[k]) for k in sizes} == {0: 1800, 1: 200}
    everything, ones = toxicity.sample(labels, rows=1 << 30)
    assert everything.count() == 2000 and set(ones.values()) == {1.0}
    none, nothing = toxicity.sample(labels.limit(0))
    assert none.count() == 0 and nothing == {}
