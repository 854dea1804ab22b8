"""Flat source files: presence, text-faithful reading and the file manifest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trastienda.sources.settle import settle

# The columns of the source files, all read as text.
POS_COLUMNS = ("venta_id", "fecha_hora", "tienda_id", "sku", "cantidad", "monto", "moneda", "tipo_comprobante")
FX_COLUMNS = ("fecha", "currency", "rate_to_mxn")
BLOCK_BYTES = 4 << 20
MALFORMED = "_malformed"


def text_schema(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{c} STRING" for c in columns)


@dataclass(frozen=True)
class SourceFiles:
    """Where the four sources lie inside a data folder; each may be a file or a folder of parts."""

    folder: str
    names: dict[str, str] = field(
        default_factory=lambda: {
            "pos": "sales.csv",
            "erp": "inventory.json",
            "ecommerce": "ecommerce_orders.parquet",
            "fx": "exchange_rates.csv",
        }
    )
    #: Whether quoted fields of the CSV sources hold line breaks.
    line_breaks: bool = False
    #: Whether the inventory export is so large a document that it is read in byte ranges.
    split_export: bool = False

    def path(self, source: str) -> str:
        return f"{self.folder.rstrip('/')}/{self.names[source]}"


def require_sources(spark: SparkSession, files: SourceFiles) -> None:
    """Raise before any work starts if a source is missing, naming all that are."""
    missing = [name for source, name in files.names.items() if not _exists(spark, files.path(source))]
    if missing:
        raise FileNotFoundError(f"missing source files in {files.folder}: {', '.join(missing)}")


def _exists(spark: SparkSession, path: str) -> bool:
    """Listing needs no schema and opens no file."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_text_csv(spark: SparkSession, path: str, columns: tuple[str, ...], multi_line: bool = False) -> DataFrame:
    """A CSV with header in which every field stays text; an empty field is NULL.

    With `multi_line` a quoted field may hold line breaks; each file is then read by one
    task. `read_split_csv` reads such files in splits.
    """
    return _csv(spark, path, text_schema(columns), multi_line)


def malformed_rows(spark: SparkSession, path: str, columns: tuple[str, ...], multi_line: bool = False) -> DataFrame:
    """The rows, as they stand in the file, that have more or fewer fields than the header."""
    # a reader that skips columns would not see how many fields a row has
    read = _csv(spark, path, f"{text_schema(columns)}, {MALFORMED} STRING", multi_line, columnPruning=False)
    # stored, since the reader gives a row's text only together with a field
    return settle(read.where(F.col(MALFORMED).isNotNull()).select(columns[0], F.col(MALFORMED).alias("row")))


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, first, record): the records of CSV files whose quoted fields may hold line breaks, read in splits.

    A task reads the lines of a byte range and can't know whether it begins inside a quoted field. An odd
    number of quotes in a range turns that over for the next one, so a running sum of the ranges' quotes tells
    for each how it begins, and a running sum inside it where records start. Records of one line are
    ready there; the lines of the others are brought together, also over ranges. `first` marks a file's first record.
    """
    where = F.col("_metadata")
    source = spark.read.option("lineSep", "\n").text(path).select(
        where["file_path"].alias("path"), where["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")
    )
    # written once, so that the ranges are the same for both passes
    lines = settle(source.withColumn("quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))))
    in_file, in_range = Window.partitionBy("path").orderBy("block"), Window.partitionBy("path", "block").orderBy("at")
    before = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = lines.groupBy("path", "block").agg(F.sum("quotes").alias("quotes"))
    ranges = ranges.select("path", "block", F.coalesce(F.sum("quotes").over(before(in_file)), F.lit(0)).alias("quotes_before"))
    run = F.col("quotes_before") + F.coalesce(F.sum("quotes").over(before(in_range)), F.lit(0))
    starts = lines.join(ranges, ["path", "block"]).withColumn("starts", run % 2 == 0)
    numbered = settle(starts.withColumn("number", F.sum(F.col("starts").cast("long")).over(in_range)))
    # a line that belongs to a record of an earlier range is counted to the last range with a start
    counts = numbered.groupBy("path", "block").agg(F.max("number").alias("records"))
    owner = F.last(F.when(F.col("records") > 0, F.struct("block", "records")), True).over(before(in_file))
    owners = counts.select("path", "block", owner.alias("owner"))
    one_line = numbered.where("starts AND quotes % 2 = 0").select("path", ((F.col("block") == 0) & (F.col("number") == 1)).alias("first"), F.col("line").alias("record"))
    parts = numbered.where("NOT starts OR quotes % 2 = 1").join(owners, ["path", "block"])
    own = F.struct("block", F.col("number").alias("records"))
    parts = parts.withColumn("record", F.when(F.col("number") > 0, own).otherwise(F.col("owner")))
    together = parts.groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("lines"))
    joined = together.select(
        "path",
        ((F.col("record.block") == 0) & (F.col("record.records") == 1)).alias("first"),
        F.array_join(F.col("lines.line"), "\n").alias("record"),
    )
    records = one_line.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return records.withColumn("record", F.when(F.col("first"), F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record"))).where("record <> ''")


def read_split_csv(spark: SparkSession, path: str, columns: tuple[str, ...], header: bool = True) -> DataFrame:
    """Like `read_text_csv` with `multi_line`, but a file of any size is read by many tasks."""
    return _parsed(spark, path, columns, header).select(*columns)


def malformed_split_rows(spark: SparkSession, path: str, columns: tuple[str, ...], header: bool = True) -> DataFrame:
    """(row): the records that have more or fewer fields than the header, as they stand in the file."""
    return _parsed(spark, path, columns, header).where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("row"))


def _parsed(spark: SparkSession, path: str, columns: tuple[str, ...], header: bool) -> DataFrame:
    records = split_records(spark, path)
    records = records.where(~F.col("first")) if header else records
    parsed = F.from_csv("record", f"{text_schema(columns)}, {MALFORMED} STRING", {"escape": '"', "columnNameOfCorruptRecord": MALFORMED})
    return records.select(F.inline(F.array(parsed)))


def _csv(spark: SparkSession, path: str, schema: str, multi_line: bool, **options: bool) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .options(**options)
        .csv(path)
    )


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def file_manifest(spark: SparkSession, paths: dict[str, str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Source, file name, SHA-256 and size of every file; a folder gives one row per part.

    Listing reads no content. Each file is hashed by one task as a stream of blocks, so that
    a file of any size needs one block of memory.
    """
    listed = reduce(
        DataFrame.unionByName,
        [spark.read.format("binaryFile").load(path).select(F.lit(source).alias("source"), "path", F.col("length").alias("bytes")) for source, path in paths.items()],
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for path in batch.column("path").to_pylist():
                system, name = fs.FileSystem.from_uri(path)
                digest = hashlib.sha256()
                with system.open_input_stream(name, compression=None) as content:
                    while block := content.read(block_bytes):
                        digest.update(block)
                digests.append(digest.hexdigest())
            names = [path.rsplit("/", 1)[-1] for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source"), pa.array(names, pa.string()), pa.array(digests, pa.string()), batch.column("bytes")],
                ["source", "file_name", "sha256", "bytes"],
            )

    return listed.mapInArrow(hashed, "source STRING, file_name STRING, sha256 STRING, bytes BIGINT")
