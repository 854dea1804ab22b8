"""Exact deduplication with the keyed state of a stream.

Texts arrive as a stream of files. A streaming aggregation keeps, per SHA-256 digest and
without expiry, how many rows had it, the largest doc_id among them and where that row's
bytes lie (file and row). The state is RocksDB on disk, snapshots of it go to the shared
folder, and later deliveries continue from it. Digests that more than one row has are
hits: the bytes of the retained row are fetched by its place, and every other row of
the digest is compared with them byte for byte. Rows that differ all the same (a clash of
digests) are grouped by their bytes.

Main path: DataFrame functions only, streaming and batch.

Defined cases: null text is empty text, an empty table gives an empty result, of rows with
equal text and equal (or null) doc_id the one with the last place stays, other columns
are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.llm.common import located, text_of
from trastienda.session import shared_folder
from trastienda.sources.settle import new_folder, settle, settle_only

#: The comparison of a group of copies is dealt into parts of about so many rows.
ROWS_PER_PART = 256
#: Small rows of a digest are dealt into so many parts before they meet its state.
DEAL = 32
FILES_PER_BATCH = 1000
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    # a store of each partition would reserve megabytes of disk ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
LOG = "digest string, n long, doc_id long, place string, batch long"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(frame: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    where = F.concat_ws(":", F.col("m.file_path"), F.lpad(F.col("m.row_index").cast("string"), 19, "0"))
    return (
        frame.select(frame.metadataColumn("_metadata").alias("m"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .withColumn("place", where)
        .withColumn("digest", digest(F.col("text")))
        .drop("m")
    )


def _last(doc_id: str = "doc_id", place: str = "place") -> Column:
    """The row that stays is the largest of these; a null doc_id is below all others."""
    return F.max(F.struct(F.col(doc_id).alias("doc_id"), F.col(place).alias("place")))


def remember(spark: SparkSession, path: str, state: str, digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Take the files under `path` that the state in folder `state` hasn't seen; returns (digest, n, doc_id, place) of all."""
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        # as a pattern, since a stream takes no path of a single file
        source = f"{path[:-1]}[{path[-1]}]"
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        keyed = _rows(stream, digest).groupBy("digest").agg(F.count("*").alias("n"), _last().alias("last"))

        def log(changed: DataFrame, batch: int) -> None:
            changed.select("digest", "n", "last.*", F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{state}/log/batch-{batch:09d}")

        query = keyed.writeStream.outputMode("update").foreachBatch(log).option("checkpointLocation", f"{state}/progress").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    if not spark.read.parquet(path).take(1):
        return spark.createDataFrame([], LOG).drop("batch")
    # the state of a digest only grows, so its largest entries are its latest
    changes = spark.read.schema(LOG).parquet(f"{state}/log/batch-*")
    return changes.groupBy("digest").agg(F.max("n").alias("n"), _last().alias("last")).select("digest", "n", "last.*")


def exact_dedup(spark: SparkSession, path: str, state: str | None = None, digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per row of the Parquet files under `path`: doc_id, place, keep_id, group_size, kept, digest."""
    state = state or f"{shared_folder(spark)}/dedup-{uuid.uuid4().hex}"
    known = settle(remember(spark, path, state, digest, files_per_batch))
    alone = known.where("n = 1").select("doc_id", "place", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")

    # rows whose digest more than one row has, with their texts
    part = F.pmod(F.xxhash64("place"), F.lit(DEAL).cast("long"))
    hit_keys = known.where("n > 1").select("digest", "n", F.col("doc_id").alias("last_id"), F.col("place").alias("last_place"))
    hit_keys = hit_keys.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEAL - 1).cast("long"))))
    rows = _rows(spark.read.parquet(path), digest).withColumn("deal", part)
    hits = settle(rows.join(hit_keys, ["digest", "deal"]).drop("deal"))

    # the retained bytes against those of each hit, large groups in parts
    parts = F.ceil(F.col("n") / ROWS_PER_PART)
    retained = hits.where(F.col("place") == F.col("last_place")).select("digest", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.col("text").alias("bytes"))
    dealt = hits.withColumn("part", F.pmod(F.xxhash64("place"), parts))
    compared = settle(
        dealt.join(retained, ["digest", "part"]).select("digest", "part", "doc_id", "place", "last_id", "last_place", "n", F.when(F.col("text") != F.col("bytes"), F.col("text")).alias("other"))
    )
    same, clash = compared.where("other IS NULL"), compared.where("other IS NOT NULL")
    lost = clash.groupBy("digest", "n").agg(F.count("*").alias("lost"))
    lost = lost.select("digest", "lost", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    same = same.join(lost, ["digest", "part"], "left").select(
        "doc_id", "place", F.col("last_id").alias("keep_id"), (F.col("n") - F.coalesce("lost", F.lit(0))).alias("group_size"), (F.col("place") == F.col("last_place")).alias("kept"), "digest"
    )
    classes = clash.groupBy("digest", "other").agg(F.count("*").alias("group_size"), _last().alias("last"))
    apart = clash.join(classes, ["digest", "other"]).select(
        "doc_id", "place", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("place") == F.col("last.place")).alias("kept"), "digest"
    )
    return alone.unionByName(same).unionByName(apart)


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without their exact copies; ids and texts land in the shared folder as the stream's delivery, until it is known which rows stay."""
    rows = located(docs, [F.struct("*").alias("row"), F.col("doc_id"), F.col("text")])

    def kept() -> DataFrame:
        inbox = new_folder(spark, f"inbox-{uuid.uuid4().hex}")
        delivery = rows.select("doc_id", "text", F.col("place").alias("origin"))
        delivery.write.parquet(inbox)
        landed = spark.read.schema(delivery.schema).parquet(inbox)
        where = F.concat_ws(":", F.col("m.file_path"), F.lpad(F.col("m.row_index").cast("string"), 19, "0"))
        origins = landed.select("origin", landed.metadataColumn("_metadata").alias("m")).select("origin", where.alias("place"))
        return origins.join(exact_dedup(spark, inbox).where("kept").select("place"), "place", "left_semi").select(F.col("origin").alias("place"))

    return rows.join(settle_only(kept), "place", "left_semi").select("row.*")
