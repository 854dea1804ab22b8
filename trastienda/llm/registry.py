"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from trastienda.llm import alignment, exact_dedup, forest, language, mixing, packing, periods, personal, quality, secrets, simhash, toxicity, warc
from trastienda.llm.common import held_out, table
from trastienda.sources.settle import settle


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language.learn(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = language.predict(docs, known, F.col("doc_id"))
    return found.select(F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.by_time(mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"]))
    times = [F.get("times", F.lit(k)).alias(name) for k, name in enumerate(("first_time", "second_time", "third_time"))]
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken", *times)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    chosen, weights = toxicity.sample(labels.where(~held_out(F.col("doc_id"))))
    model = toxicity.learn(docs.join(F.broadcast(chosen), "doc_id"), weights)
    found = toxicity.score(docs, model, F.col("doc_id")).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "n_passages")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    counts = settle(quality.counted(docs, F.struct("doc_id", "lang")).select("key.doc_id", F.col("key.lang").alias("stratum"), *quality.BASE, "n_lines"))
    labelled = counts.join(labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))), "doc_id").withColumn("good", F.col("quality") == 1)
    cutoffs = quality.learn(labelled, F.crc32(F.col("doc_id").cast("string")) % 5 == 1)
    return quality.judged(counts, cutoffs).select("doc_id", *quality.BASE, "base_failed", "kept", F.concat_ws(",", "failed").alias("failed_rules"))


def op7_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secrets(table(spark, sf_dir, "documents")))


def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.col("key").eqNullSafe(F.col("component")).alias("kept"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.period_runs(table(spark, sf_dir, "documents"), alter=True).withColumnRenamed("key", "doc_id")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.alignment(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_curriculum_mix": op4_curriculum_mix,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash_trie": op7_simhash_trie,
    "op8_warc": op8_warc,
    "op9_personal_data": op9_personal_data,
    "op10_secret_scan": op10_secret_scan,
    "op11_lsh_forest": op11_lsh_forest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op8_warc": """
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
               CASE WHEN octet_length(encode(coalesce(html, ''))) < 1000 OR page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
        FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))
    """,
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_curriculum_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS deal,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::DOUBLE AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM sized GROUP BY source
        ), weighed AS (
            SELECT *, CASE k % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM sources
        ), levels AS (
            -- the level at which what the sources take, each at most 3 times its size, is all there is
            SELECT a.s * 3 / a.w AS level, sum(least(b.s * 3, a.s * 3 / a.w * b.w)) AS taken FROM weighed a, weighed b GROUP BY a.k, a.s, a.w
        ), limits AS (
            SELECT max(level) AS full_level FROM levels WHERE taken <= (SELECT sum(s) FROM weighed)
        ), capped AS (
            SELECT weighed.*, s * 3 / w <= coalesce((SELECT full_level FROM limits), -1) AS is_full FROM weighed
        ), goals AS (
            SELECT source, k, s, CASE WHEN is_full THEN s * 3 ELSE w * ((SELECT sum(s) FROM capped) - coalesce((SELECT sum(s * 3) FROM capped WHERE is_full), 0))
                   / (SELECT sum(w) FROM capped WHERE NOT is_full) END AS target FROM capped
        ), placed AS (
            SELECT sized.*, k, s, target, floor(target / s) AS passes,
                   sum(size) OVER (PARTITION BY sized.source ORDER BY deal, doc_id, size ROWS UNBOUNDED PRECEDING) - size + size / 2 AS middle
            FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
        ), copied AS (
            SELECT *, passes + CASE WHEN middle < target - passes * s THEN 1 ELSE 0 END AS copies, least(middle / target, 1.0) AS part_0,
                   least((s + middle) / target, 1.0) AS part_1, least((2 * s + middle) / target, 1.0) AS part_2 FROM placed
        )
        SELECT doc_id, size, s::BIGINT AS source_size, target, (size * copies)::BIGINT AS taken,
               CASE WHEN copies > 0 THEN CASE k % 3
                    WHEN 0 THEN 0.0 + (sqrt(49.0 + -8.0 * ((part_0 - 0.0) * 5.0)) - 7.0) / -4.0
                    WHEN 1 THEN 0.0 + (part_0 - 0.0) * 2.0 / 2.0
                    ELSE CASE WHEN part_0 < 0.25 THEN 0.0 + (part_0 - 0.0) * 1.0 / 0.5
                         ELSE 0.5 + (sqrt(0.25 + 8.0 * ((part_0 - 0.25) * 1.0)) - 0.5) / 4.0 END END END AS first_time,
               CASE WHEN copies > 1 THEN CASE k % 3
                    WHEN 0 THEN 0.0 + (sqrt(49.0 + -8.0 * ((part_1 - 0.0) * 5.0)) - 7.0) / -4.0
                    WHEN 1 THEN 0.0 + (part_1 - 0.0) * 2.0 / 2.0
                    ELSE CASE WHEN part_1 < 0.25 THEN 0.0 + (part_1 - 0.0) * 1.0 / 0.5
                         ELSE 0.5 + (sqrt(0.25 + 8.0 * ((part_1 - 0.25) * 1.0)) - 0.5) / 4.0 END END END AS second_time,
               CASE WHEN copies > 2 THEN CASE k % 3
                    WHEN 0 THEN 0.0 + (sqrt(49.0 + -8.0 * ((part_2 - 0.0) * 5.0)) - 7.0) / -4.0
                    WHEN 1 THEN 0.0 + (part_2 - 0.0) * 2.0 / 2.0
                    ELSE CASE WHEN part_2 < 0.25 THEN 0.0 + (part_2 - 0.0) * 1.0 / 0.5
                         ELSE 0.5 + (sqrt(0.25 + 8.0 * ((part_2 - 0.25) * 1.0)) - 0.5) / 4.0 END END END AS third_time
        FROM copied
    """,
}
