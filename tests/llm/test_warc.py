import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from trastienda.llm import warc

PAGES = [
    (1, "http://a/", "x" * 1000),
    (2, "http://b/ä b", "x" * 1000),
    (2, "http://b/2", "x" * 1000),
    (3, None, "x" * 999),
    (4, "http://c/\r\nX: 1", "x" * 999),
    (5, "http://d/", None),
    (6, "http://e/", ""),
    (7, "http://f/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60),
    (8, "http://g/", "é🙂" * 50_000),
    (None, "http://h/", "y" * 1500),
    (None, "http://i/", "z" * 1500),
    (9, "http://j/", "z" * 1500),
]


def expected(rows, least=1000):
    last = {}
    for page_id, _, html in rows:
        last[html] = max((x for x in (last.get(html), page_id) if x is not None), default=None)
    found = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        revisit = len(payload) >= least and page_id != last[html]
        found.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", last[html] if revisit else None))
    return sorted(found, key=str)


def found(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*row, "path", 1) for row in PAGES], "page_id long, url string, html string, path string, bytes int")


def test_odd_rows(spark, pages):
    assert found(warc.round_trip(spark, pages)) == expected(PAGES)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


@pytest.mark.parametrize("split", [1, 7, 100, 333, 4096])
def test_any_split_gives_every_record_once(spark, pages, tmp_path, split):
    folder = str(tmp_path / "w")
    manifest = warc.write(pages.where("length(html) < 2000 OR html IS NULL").coalesce(1), folder, archive_bytes=2000)
    assert manifest.count() > 1
    rows = [r for r in PAGES if len(r[2] or "") < 2000]
    if split >= 100:
        assert found(warc.read(spark, folder, manifest, split)) == expected(rows)
    starts = []
    for path, size, _ in manifest.collect():
        file = pa.OSFile(f"{folder}/{path}")
        starts += [p for begin in range(0, size, split) for p, _, _ in warc.records_in(file, begin, begin + split, size)]
    assert len(starts) == len(rows)


def test_texts_come_back(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    rows = warc.read(spark, folder, warc.write(pages, folder), with_payload=True).collect()
    stored = sorted((r.payload.decode() for r in rows if r.record_type == "response"))
    assert stored == sorted(["x" * 1000] * 2 + ["x" * 999] * 2 + ["", "", PAGES[7][2], PAGES[8][2], "y" * 1500, "z" * 1500])


def test_magic_bytes_that_are_no_record():
    rng = random.Random(1)
    junk = b"".join(warc.MAGIC + rng.randbytes(rng.randrange(50)) for _ in range(50)) + zlib.compress(b"WARC/1.1\r\n\r\n", wbits=31) + zlib.compress(b"not a record", wbits=31)
    member = warc.record(1, "u", b"payload", 7, hashlib.sha1(b"payload").hexdigest(), None)
    data = junk + member + member[:20]
    hits = list(warc.records_in(pa.BufferReader(data), 0, len(data), len(data)))
    assert [position for position, _, _ in hits] == [len(junk)] and hits[0][2].endswith(b"\r\n\r\npayload")


def test_changed_payloads_are_noticed(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    manifest = warc.write(pages.limit(1), folder)
    (path,) = [r.path for r in manifest.collect()]
    (tmp_path / "w" / path).write_bytes(warc.record(1, "u", b"other", 5, "0" * 40, None))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read(spark, folder, manifest).collect()


def long_url(n):
    rng = random.Random(2)
    return "http://k/" + "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))


@pytest.mark.parametrize("split", [20_000, 1 << 20])
def test_headers_of_any_length(spark, tmp_path, split):
    """A header of more than a mebibyte is read on while it may still be one."""
    rows = [(1, "http://a/", "x" * 50), (2, long_url(130_000), "y" * 2000), (3, "http://b/", "z" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = str(tmp_path / "w")
    manifest = warc.write(pages, folder)
    read = warc.read(spark, folder, manifest, split)
    assert found(read) == expected(rows) and warc.incomplete(read, manifest).count() == 0
    assert max(len(r.target) for r in read.collect()) > 1 << 20


def test_what_can_not_become_a_header_is_left_early():
    assert warc.may_be_header(b"WARC/1.1\r\nA: b\r\nC") and warc.may_be_header(b"WA")
    assert not warc.may_be_header(b"WARC/1.1\r\nno field\r\nA") and not warc.may_be_header(b"WARC/1.1\r\nA: b\r\n\r\n")


def test_a_lost_record_is_told(spark, pages, tmp_path, monkeypatch):
    folder = str(tmp_path / "w")
    manifest = warc.write(pages.coalesce(1), folder)
    rows = warc.read(spark, folder, manifest)
    lost = warc.incomplete(rows.where("page_id <> 7 OR page_id IS NULL"), manifest).collect()
    assert [(r.records, r.found) for r in lost] == [(len(PAGES), len(PAGES) - 1)]
    assert [r.found for r in warc.incomplete(rows.limit(0), manifest).collect()] == [0]
    written = warc.write
    monkeypatch.setattr(warc, "write", lambda *a: written(*a).withColumn("records", warc.F.col("records") + 1))
    with pytest.raises(ValueError, match="yields"):
        warc.round_trip(spark, pages)
