import brute
import pytest
from pyspark.sql import functions as F

from trastienda.llm import language
from trastienda.llm.registry import QUERIES


def test_held_out_accuracy(spark, sf, documents):
    rows = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, sf).collect()}
    assert len(rows) == len(documents)
    assert all(rows[d].held_out == brute.held(d) for d, *_ in documents)
    apart = [(lang, rows[d]) for d, _, lang, _ in documents if rows[d].held_out]
    assert sum(lang == r.lang_pred for lang, r in apart) >= 0.97 * len(apart)
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert sum(r.accepted for r in rows.values()) >= 0.97 * len(rows)


def test_held_out_rows_and_other_columns_teach_nothing(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    other.write.parquet(str(tmp_path / "documents.parquet"))
    first, second = (sorted(map(str, QUERIES["op2_language_id"](spark, path).collect())) for path in (sf, str(tmp_path)))
    assert first == second


def test_odd_rows(spark, sf, odd, nothing, odd_rows):
    known = language.learn(spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang"))
    rows = language.predict(odd, known, F.struct("doc_id", "text")).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.key.text or ""))
        assert not (r.lang_pred == "und" and (r.accepted or r.score))
    assert language.keep_known(odd, known).columns == odd.columns
    assert language.keep_known(nothing, known).count() == 0
    none = language.learn(nothing.select("text", "lang"))
    assert {r.lang_pred for r in language.predict(odd, none, F.col("doc_id")).collect()} == {"und"}
    one = language.learn(odd.where("lang = 'de'").select("text", "lang"))
    assert one.names == ["de"]


def test_sample_is_bounded(spark):
    rows = [(f"{k} some words of a text " * 50, "en") for k in range(200)]
    known = language.learn(spark.createDataFrame(rows, "text string, lang string"), sample_docs=5, sample_chars=100)
    assert len(known.contents[0]) <= 5 * 101


def test_ties_go_to_the_most_frequent_language():
    assert language.judge([7, 5, 5]) == (1, pytest.approx(1 / 2.25), 0.0)


def test_every_block_counts(spark, sf):
    known = language.learn(spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang"))
    scales = language.Scales(known, language.LEVEL)
    text = "word " * 5000
    assert scales.weigh(text + "und der die " * 3000) != scales.weigh(text + "the of and " * 3000)
