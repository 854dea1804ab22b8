"""WARC archives: a writer, and a reader that splits archives anywhere.

Each record is a gzip member of its own. A reading task gets a byte range. It looks for the magic
bytes of gzip there, decodes each candidate's beginning and takes it for a record if that is a WARC header
with the mandatory fields; from then on members follow each other. A record belongs to
the range in which it starts, so neighbouring ranges share none and lose none, and a task reads
beyond its end only to finish its last record.

Archives are in the shared folder and are opened through pyarrow's file systems. A writing task
that runs again writes files of its own; only those that the manifest names are read.

Defined cases: null html is an empty payload; a null url is an empty target; null page_ids come
back as null and never are the response that others revisit while there is another; rows
that share the largest page_id of a payload are all responses; an empty table gives no
archives and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.session import shared_folder
from trastienda.sources.settle import settle

#: Payloads that are shorter are always stored.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
SPLIT_BYTES = 4 << 20
READ = 1 << 20
GZIP_LEVEL = 4
MAGIC = b"\x1f\x8b\x08"
#: Rows of a payload with copies are dealt into so many parts.
DEAL = 32
MANIFEST = "path string, bytes long, records long"
RECORDS = "path string, position long, record_type string, page_id long, refers_to long, target string, payload_bytes long, payload_digest string"


def planned(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is null for responses."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    # equal payloads have equal digests of both kinds
    rows = rows.withColumns({"digest": F.sha1("html"), "same": F.when(F.octet_length("html") >= revisit_bytes, F.sha2("html", 256))})
    copies = rows.where("same IS NOT NULL").groupBy("same").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEAL - 1).cast("long")))
    rows = rows.withColumn("deal", F.pmod(F.xxhash64("page_id", "url"), F.lit(DEAL).cast("long")))
    rows = rows.join(copies.withColumn("deal", parts), ["same", "deal"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.select("page_id", "url", F.when(refers.isNull(), F.col("html")).alias("html"), F.octet_length("html").cast("long").alias("payload_bytes"), "digest", refers.alias("refers_to"))


def record(page_id: int | None, url: str, html: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """A record as a gzip member. The HTTP header, which a revisit keeps, has the payload's length."""
    kind = "response" if refers_to is None else "revisit"
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (html or b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Archives of about `archive_bytes` below `folder`; returns the manifest (path, bytes, records)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        done, out, path, size, records = [], None, "", 0, 0

        def close() -> None:
            if out is not None:
                out.close()
                done.append((path, size, records))

        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(batch.num_columns)), strict=True):
                if out is None or size >= archive_bytes:
                    close()
                    path, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{path}", compression=None)
                member = record(*(x.as_py() for x in row))
                out.write(member)
                size, records = size + len(member), records + 1
        close()
        columns = list(zip(*done, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "bytes", "records"])

    return settle(planned(pages, revisit_bytes).mapInArrow(scan, MANIFEST))


class Range:
    """Bytes of an archive from a position on, read as they are needed."""

    def __init__(self, file: pa.NativeFile, begin: int, size: int) -> None:
        self.file, self.base, self.size, self.bytes = file, begin, size, bytearray()
        file.seek(begin)

    def more(self) -> bool:
        got = self.file.read(READ)
        self.bytes += got
        return bool(got)

    def find(self, position: int, end: int) -> int:
        """The next magic bytes that begin before `end`, or -1."""
        while True:
            found = self.bytes.find(MAGIC, position - self.base)
            if found >= 0:
                return found + self.base if found + self.base < end else -1
            position = max(position, self.base + len(self.bytes) - len(MAGIC) + 1)
            if position >= end or not self.more():
                return -1

    def member(self, position: int) -> tuple[bytes, int] | None:
        """The record that starts here and the position after it; None if no record does."""
        self.bytes, self.base = self.bytes[position - self.base :], position
        unpacker, at, parts, known = zlib.decompressobj(31), 0, [], False
        grown = looked = 0
        try:
            while not unpacker.eof:
                if at >= len(self.bytes) and not self.more():
                    return None
                piece = bytes(self.bytes[at : at + 8192])
                parts.append(unpacker.decompress(piece))
                at += len(piece)
                grown += len(parts[-1])
                # looked at whenever it has doubled, so a header of any length costs in proportion
                if not known and (grown >= 2 * looked or unpacker.eof):
                    looked, begin = grown, b"".join(parts)
                    if not begin.startswith(b"WARC/1."[: len(begin)]):
                        return None
                    known = header(begin) is not None
                    if not known and not may_be_header(begin):
                        return None
        except zlib.error:
            return None
        return (b"".join(parts), position + at - len(unpacker.unused_data)) if known else None


def may_be_header(begin: bytes) -> bool:
    """Could more bytes make this a WARC header? Its full lines are fields, and no empty line has come."""
    lines = begin.split(b"\r\n")
    return b"\r\n\r\n" not in begin and all(b":" in line for line in lines[1:-1])


def header(begin: bytes) -> tuple[dict[str, str], int] | None:
    """The fields of a WARC header and its length; None if this isn't one."""
    end = begin.find(b"\r\n\r\n")
    if end < 0 or not begin.startswith(b"WARC/1."):
        return None
    lines = begin[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    needed = ("warc-type", "warc-record-id", "warc-date", "content-length")
    return (fields, end + 4) if all(k in fields for k in needed) and fields["content-length"].isdigit() else None


def records_in(file: pa.NativeFile, begin: int, end: int, size: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, header fields, block) of the records that start in the range."""
    window, position = Range(file, begin, size), begin
    while (found := window.find(position, end)) >= 0:
        record_ = window.member(found)
        if record_ is None:
            position = found + 1
            continue
        fields, length = header(record_[0])
        yield found, fields, record_[0][length : length + int(fields["content-length"])]
        position = record_[1]


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read(spark: SparkSession, folder: str, manifest: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives; stored payloads are held against their digests."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(starts).alias("begin"))
    tasks = max(1, ranges.count())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, size, begin in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                rows, held = [], 0
                with system.open_input_file(f"{root}/{path}") as file:
                    for position, fields, block in records_in(file, begin, begin + split_bytes, size):
                        top, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields.get("warc-payload-digest", "").partition(":")[2]
                        stored = fields["warc-type"] == "response"
                        if stored and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{path} at {position}: the payload differs from its digest")
                        length = len(payload) if stored else int(re.search(rb"(?i)content-length: *(\d+)", top)[1])
                        row = (path, position, fields["warc-type"], _page(fields["warc-record-id"]), _page(fields.get("warc-refers-to")), fields.get("warc-target-uri"), length, digest)
                        rows.append((*row, payload if stored else None) if with_payload else row)
                        held += len(payload)
                        if held > READ:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = RECORDS + ", payload binary" * with_payload
    fields_of = [x.split() for x in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(fields_of)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields_of, strict=True)], [name for name, _ in fields_of])

    dealt = ranges.repartition(min(tasks, 4096), "path", "begin") if tasks > 1 else ranges
    return dealt.mapInArrow(scan, schema)


def incomplete(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, records, found) of archives that yield another number of records than the manifest says."""
    found = rows.groupBy("path").agg(F.count("*").alias("found"))
    counts = manifest.join(found, "path", "full").select("path", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("records", "found")])
    return counts.where("records <> found")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The pages written to archives in the shared folder, and what the reader finds there.

    Raises if an archive doesn't yield the records that its manifest counts.
    """
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    manifest = write(pages, folder)
    rows = settle(read(spark, folder, manifest))
    if wrong := incomplete(rows, manifest).first():
        raise ValueError(f"{wrong['path']} yields {wrong['found']} of {wrong['records']} records")
    return rows
