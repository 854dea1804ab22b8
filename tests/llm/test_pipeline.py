import os
from collections import Counter

import brute
import pytest

import corpus_pipeline
from trastienda.llm import language, mixing, packing
from trastienda.session import shared_folder
from trastienda.sources.settle import settle, settle_only


def stages(spark, sf, docs, folder):
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        yield name, docs


def test_each_stage_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {"": docs} | dict(stages(spark, sf, docs, str(tmp_path)))
    names = list(got)
    assert names[1:] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "best_fit_packing"]
    for name in names[1:-1]:
        assert got[name].columns == docs.columns
    rows = {name: sorted(tuple(r) for r in frame.collect()) for name, frame in got.items()}

    known = language.learn(docs.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 0").select("text", "lang"))
    scales = language.Scales(known, language.LEVEL)
    accepted = [r for r in rows[""] if any(c.isalpha() for c in r[1] or "") and language.judge(scales.weigh(r[1]))[2] >= language.MIN_MARGIN]
    assert rows["language_id"] == accepted and len(accepted) >= 0.97 * len(rows[""])

    last = {r[1]: r[0] for r in rows["language_id"]}
    assert rows["exact_dedup"] == [r for r in rows["language_id"] if last[r[1]] == r[0]]

    label = brute.near_components([r[1] for r in rows["exact_dedup"]])
    assert rows["near_dedup"] == [r for k, r in enumerate(rows["exact_dedup"]) if label[k] == k]

    copies = Counter(rows["mix_sources"])
    assert set(copies) <= set(rows["near_dedup"])
    expected = {r.row.doc_id: r.copies for r in mixing.mix(got["near_dedup"]).collect()}
    assert {r[0]: n for r, n in copies.items()} == {d: n for d, n in expected.items() if n}

    pieces = got["best_fit_packing"].collect()
    assert sum(r.piece == 0 for r in pieces) == len(rows["mix_sources"])
    assert sum(r.length for r in pieces) == sum(len(packing.Encoder.of("byte_bpe_50k").ids(r[1])) + 1 for r in rows["mix_sources"])


def test_odd_and_no_rows(spark, sf, odd, nothing, tmp_path):
    for name, docs in (("odd", odd), ("nothing", nothing)):
        for stage, frame in stages(spark, sf, docs, str(tmp_path / name)):
            frame.count()
            if stage != "best_fit_packing":
                assert frame.columns == docs.columns


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


@pytest.mark.parametrize("name", ["exact_dedup", "near_dedup"])
def test_a_stage_leaves_only_what_its_result_reads(spark, sf, name):
    """Copies of the texts and tables that were met on the way don't stay beside the later stages."""
    shared, docs = shared_folder(spark), spark.read.parquet(f"{sf}/documents.parquet")
    before = set(os.listdir(shared))
    kept = dict(corpus_pipeline.STAGES)[name](spark, docs, sf)
    left = [x for x in set(os.listdir(shared)) - before if not x.startswith("dedup-")]
    assert len(left) == 1 and spark.read.parquet(f"{shared}/{left[0]}").columns == ["place"]
    assert 0 < kept.count() <= docs.count() and kept.columns == docs.columns


def test_what_fails_on_the_way_leaves_nothing(spark):
    shared = shared_folder(spark)
    before = set(os.listdir(shared))

    def build():
        return settle(spark.range(3)).selectExpr("raise_error('no')")

    with pytest.raises(Exception, match="no"):
        settle_only(build)
    # only the folder of the result that failed may be there
    assert all(not any(f.endswith(".parquet") for f in os.listdir(f"{shared}/{x}")) for x in set(os.listdir(shared)) - before)
    assert settle_only(lambda: settle(spark.range(3)).where("id > 0")).count() == 2
