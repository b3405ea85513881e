"""Archives: round trip, structure of the files, damage."""

import glob
import hashlib
import struct
import tempfile

import pytest
import zstandard

from tally.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/archives"


def write(spark, rows, archive_bytes=700, dictionary=b""):
    path = folder()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(1)
    warc.write_archives(warc.with_revisits(pages), path, dictionary, archive_bytes)
    return path


BIG = "<p>é " + "x" * 200
ROWS = [(1, "http://a/", BIG, None), (2, "http://b/ b\n", BIG, "clash"), (3, None, None, None), (4, "u", "", None),
        (5, "u", "short", None), (6, "u", "short", None), (-7, "u", BIG, None), (8, "u", "y" * 300_000, None),
        (8, "u", "y" * 300_000, None)]


def test_round_trip(spark):
    got = sorted(tuple(r[:6]) for r in warc.read_archives(spark, write(spark, ROWS), strict=True).collect())
    want = []
    for page_id, url, html, _ in ROWS:
        b = (html or "").encode()
        first = min(r[0] for r in ROWS if (r[2] or "") == (html or ""))
        revisit = len(b) >= 100 and first != page_id
        want.append((page_id, url and url.replace(" ", "%20").replace("\n", "%0A"), len(b), hashlib.sha256(b).hexdigest(),
                     "revisit" if revisit else "response", first if revisit else None))
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_payloads_come_back(spark):
    rows = warc.read_archives(spark, write(spark, ROWS), payloads=True).filter("record_type = 'response'").collect()
    want = {r[0]: (r[2] or "").encode() for r in ROWS}
    assert all(bytes(r.payload) == want[r.page_id] for r in rows)


def test_file_layout(spark):
    """Each file: dictionary frame first, closed by its bytes, readable by any decoder with the dictionary."""
    samples = [f"<html><body><p>page {i} of many, with common words</p></body></html>".encode() * 12 for i in range(200)]
    dictionary = warc.train_dictionary(samples)
    assert dictionary
    path = write(spark, [(i, f"http://h/{i}", samples[i % 200].decode(), None) for i in range(20)], len(dictionary) + 2000, dictionary)
    files = glob.glob(path + "/part-*")
    counts, sizes, frames = [], [], []
    for f in files:
        data = open(f, "rb").read()
        assert struct.unpack_from("<II", data) == (warc.MAGIC_DICTIONARY, len(dictionary))
        assert data[8:8 + len(dictionary)] == dictionary
        counts.append(len(list(warc.archive_records(data))))
        sizes.append(len(data) - len(warc.EMPTY_FRAME))
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        start = 8 + len(dictionary)
        frames.append(warc.frame_end(data, start) - start)
        assert decoder.decompress(data[start:warc.frame_end(data, start)]).startswith(b"WARC/1.1\r\n")
    assert sum(counts) == 20 and len(files) > 2
    limit = len(dictionary) + 2000
    assert sum(size < limit for size in sizes) <= 1 and max(sizes) < limit + 2 * max(frames)
    assert warc.read_archives(spark, path, strict=True).count() == 20


def archive(*records, dictionary=b"d" * 100, lead=True):
    c = zstandard.ZstdCompressor(level=1, write_checksum=True)
    frames = [c.compress(r) for r in records]
    return (struct.pack("<II", warc.MAGIC_DICTIONARY, 0) if lead else b"") + b"".join(frames)


def good(page_id=1, body=b"hello"):
    return warc.record_bytes(page_id, "http://x/", body, hashlib.sha256(body).hexdigest(), None)


@pytest.mark.parametrize("bad", [
    good().replace(b"WARC/1.1", b"WARC/9.9"), good().replace(b"Content-Length: 5", b"Content-Length: 6"),
    good()[:-1], good() + b"x", good().replace(b"hello", b"jello"), good().replace(b"WARC-Type", b"WARC Type:\r\nno colon"),
    good().replace(b"urn:page:1", b"urn:page:x"), b"", good().replace(b"sha256:", b"md5:"),
])
def test_damaged_records_are_found(bad):
    with pytest.raises(warc.BadRecord):
        warc.parse_record(bad)


def test_damaged_frames(spark):
    data = archive(good(1), good(2), good(3))
    assert [e for _, _, e in warc.archive_records(data)] == [None] * 3
    assert [e for _, _, e in warc.archive_records(data[:-3])] == [None, None, "frame is cut off"]
    middle = bytearray(data)
    middle[len(data) // 2 + 5] ^= 0xFF
    errors = [e for _, _, e in warc.archive_records(bytes(middle))]
    assert any(errors) and errors[0] is None
    path = folder()
    import os
    os.makedirs(path)
    open(path + "/x.warc.zst", "wb").write(archive(good(1), good(2)[:-1], good(3)))
    rows = warc.read_archives(spark, path).collect()
    assert [r.page_id for r in rows if r.error is None] == [1, 3] and sum(r.error is not None for r in rows) == 1
    with pytest.raises(Exception, match="BadRecord|Content-Length"):
        warc.read_archives(spark, path, strict=True).collect()


def test_compressed_dictionary():
    samples = [f"header common text {i} and more common text".encode() * 10 for i in range(300)]
    dictionary = warc.train_dictionary(samples)
    packed = zstandard.ZstdCompressor().compress(dictionary)
    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    data = struct.pack("<II", warc.MAGIC_DICTIONARY, len(packed)) + packed + c.compress(good(4))
    assert [r for _, r, _ in warc.archive_records(data)] == [good(4)]


def test_empty_table(spark):
    assert warc.read_archives(spark, write(spark, [])).count() == 0


def test_null_page_ids_equal_the_sql(spark):
    import duckdb
    import pandas as pd

    rows = [(None, "u", "one", None), (None, "u", "one", None), (None, "u", BIG, None), (5, "u", BIG, None), (9, "u", BIG, None),
            (None, "u", "z" * 300, None), (None, None, "z" * 300, None), (None, "u", None, None)]
    got = warc.read_archives(spark, write(spark, rows), strict=True, payloads=True).collect()
    pages = pd.DataFrame({"page_id": pd.array([r[0] for r in rows], "Int64"), "html": [r[2] for r in rows]})  # noqa: F841
    key = lambda t: tuple(str(x) for x in t)
    facts = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key)
    assert facts == sorted(duckdb.sql(warc.SQL).fetchall(), key=key)
    assert sum(r.page_id is None for r in got) == 6
    for bad in (warc.record_bytes(1, "u", b"x" * 200, "0" * 64, None, True), warc.record_bytes(1, "u", b"x" * 200, "0" * 64, 7)
                .replace(b"To: <urn:page:7>", b"To: <urn:page:null>")):
        with pytest.raises(warc.BadRecord):
            warc.parse_record(bad)


def test_large_pages_do_not_make_large_archives(spark):
    """Small pages and large incompressible ones in one task: an archive passes its bytes by one record at most."""
    import random

    rng = random.Random(3)
    big = lambda: "".join(rng.choices("0123456789abcdefghijklmnopqrstuv", k=40_000))
    rows = [(i, "u", big() if i % 10 > 6 else f"small page {i}", None) for i in range(100)]
    path = write(spark, rows, 60_000)
    sizes = [len(open(f, "rb").read()) for f in glob.glob(path + "/part-*")]
    assert len(sizes) >= 8 and max(sizes) < 60_000 + 42_000
    assert sorted(r.page_id for r in warc.read_archives(spark, path, strict=True).collect()) == list(range(100))
