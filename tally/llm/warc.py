"""WARC archives in Zstandard: writer and reader.

An archive is a series of Zstandard frames, one for each record.  It begins with a skippable
frame (magic 0x184D2A5D) that holds the dictionary all record frames need.  The reader loads
that dictionary, decodes frame by frame and checks record headers, lengths and digests.

Archives are written by Spark's own text writer, so tasks commit their files as any output
and every Hadoop file system will do: a row is one frame, and the line end is an empty
skippable frame, which every Zstandard reader steps over.  An archive holds a set number of
records, so its size is bounded.

Cases: null html is an empty payload; a null url gives a record without target address; a null
page_id gives the record id ``<urn:page:null>``, which reads back as null.  A null page_id is no
payload's smallest: with the payload of a page that has one it is a revisit that refers to no id.
Repeated pages make a record each (all rows with the smallest page_id of a payload are
responses).  An empty table makes archives without records.  A damaged record makes an
error row (`read_archives`) or ends the job (``strict``).
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import ship, stash, table, unit_interval
from tally.session import scratch_path

MAGIC_DICTIONARY = 0x184D2A5D
MAGIC_SKIPPABLE = 0x184D2A50            # up to ...5F
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
# An empty skippable frame; all its bytes are ASCII, so it can be a line separator.
EMPTY_FRAME = struct.pack("<II", MAGIC_SKIPPABLE, 0)

REVISIT_MIN_BYTES = 100
ARCHIVE_BYTES = 16 << 20                # bytes of frames that an archive is closed at
DICTIONARY_BYTES = 32 << 10
DICTIONARY_PAGES = 400                  # bound of the sample that trains the dictionary
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- records ---------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool = False) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP head alone."""
    revisit = revisit or refers_to is not None
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            fields.append(("WARC-Refers-To", record_id(refers_to)))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class BadRecord(ValueError):
    pass


def fields_of(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise BadRecord(f"header line {line[:80]!r}")
        out[name.decode("ascii", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def length_field(fields: dict[str, str], where: str) -> int:
    value = fields.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise BadRecord(f"no Content-Length in the {where} header")
    return int(value)


def page_of(value: str | None) -> int | None:
    if value == record_id(None):
        return None
    m = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    if not m:
        raise BadRecord(f"record id {value!r}")
    return int(m[1])


def parse_record(raw: bytes) -> dict:
    """Check one record and return its facts; raises BadRecord."""
    version, sep, rest = raw.partition(b"\r\n")
    if not sep or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise BadRecord(f"version line {version[:40]!r}")
    head, sep, body = rest.partition(b"\r\n\r\n")
    if not sep:
        raise BadRecord("header without end")
    fields = fields_of(head)
    n = length_field(fields, "record")
    if len(body) != n + 4 or body[n:] != b"\r\n\r\n":
        raise BadRecord(f"Content-Length {n}, block of {len(body) - 4}")
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        raise BadRecord(f"WARC-Type {kind!r}")
    http, sep, payload = body[:n].partition(b"\r\n\r\n")
    if not sep or not http.startswith(b"HTTP/"):
        raise BadRecord("no HTTP header")
    size = length_field(fields_of(http.partition(b"\r\n")[2]), "HTTP")
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha256" or not re.fullmatch("[0-9a-f]{64}", digest):
        raise BadRecord("payload digest")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise BadRecord("payload differs from its length or digest")
    if kind == "revisit" and payload:
        raise BadRecord("revisit with a payload")
    page_id, refers_to = page_of(fields.get("warc-record-id")), None
    if kind == "revisit" and not (page_id is None and "warc-refers-to" not in fields):
        refers_to = page_of(fields.get("warc-refers-to"))
        if refers_to is None:
            raise BadRecord("revisit of a record without page_id")
    return {"page_id": page_id, "url": fields.get("warc-target-uri"),
            "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": refers_to,
            "payload": payload if kind == "response" else None}


# -- frames ----------------------------------------------------------------

def frame_end(data, pos: int) -> int:
    """End of the Zstandard frame at ``pos``, by its block headers."""
    flags = data[pos + 4]
    single = flags >> 5 & 1
    pos += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    while True:
        if pos + 3 > len(data):
            raise BadRecord("frame is cut off")
        block = int.from_bytes(data[pos:pos + 3], "little")
        pos += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    pos += 4 * (flags >> 2 & 1)
    if pos > len(data):
        raise BadRecord("frame is cut off")
    return pos


def archive_records(data: bytes):
    """Yield (offset, record bytes or None, error or None) of an archive held in memory."""
    view, pos, decoder, first = memoryview(data), 0, zstandard.ZstdDecompressor(), True
    while pos < len(view):
        if pos + 8 > len(view):
            yield pos, None, "trailing bytes"
            return
        magic, size = struct.unpack_from("<II", view, pos)
        if magic & ~0xF == MAGIC_SKIPPABLE:
            if pos + 8 + size > len(view):
                yield pos, None, "skippable frame is cut off"
                return
            if first and magic == MAGIC_DICTIONARY:
                content = bytes(view[pos + 8:pos + 8 + size])
                if content[:4] == ZSTD_MAGIC:       # the dictionary may itself be compressed
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            pos, first = pos + 8 + size, False
            continue
        first = False
        if bytes(view[pos:pos + 4]) != ZSTD_MAGIC:
            yield pos, None, "neither a frame nor a skippable frame"
            return
        try:
            end = frame_end(view, pos)
        except (BadRecord, IndexError):
            yield pos, None, "frame is cut off"
            return
        try:
            yield pos, decoder.decompressobj().decompress(view[pos:end]), None
        except zstandard.ZstdError as e:
            yield pos, None, str(e)
        pos = end


def dictionary_frame(content: bytes) -> bytes:
    return struct.pack("<II", MAGIC_DICTIONARY, len(content)) + content


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from a bounded sample; empty if there is too little to learn from."""
    if len(samples) < 20 or sum(map(len, samples)) < 10 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


# -- Spark -----------------------------------------------------------------

def with_revisits(pages: DataFrame) -> DataFrame:
    """Add payload (bytes), payload_bytes, payload_digest, revisit and refers_to (null for responses) to page_id, url, html."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                         F.to_binary(html, F.lit("utf-8")).alias("payload"),
                         F.octet_length(html).cast("long").alias("payload_bytes"),
                         F.sha2(html, 256).alias("payload_digest"))
    narrow = pages.select("page_id", "payload_bytes", "payload_digest").filter(F.col("payload_bytes") >= REVISIT_MIN_BYTES)
    # only payloads that occur again; a small table beside the pages
    first = stash(narrow.groupBy("payload_digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
                  .filter("_n > 1").drop("_n"), "first-payloads")
    joined = pages.join(first, "payload_digest", "left")
    return joined.withColumns({
        "revisit": F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id")),
        "refers_to": F.when(F.col("_first") != F.col("page_id"), F.col("_first"))}).drop("_first")


def write_archives(records: DataFrame, path: str, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write page_id, url, payload, payload_digest, refers_to, revisit as archives, cut by bytes.

    An archive ends with the record that brings its frames to ``archive_bytes`` or more, so it is larger than that by
    one record at most, whatever the payloads of its task.  It is one row of the text sink, one row a file.
    """
    lead = dictionary_frame(dictionary)

    def frames(it):
        options = {"level": 3, "write_content_size": True, "write_checksum": True}
        if dictionary:
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        encoder, held = zstandard.ZstdCompressor(**options), bytearray()
        for batch in it:
            columns = [batch.column(i) for i in range(6)]
            for page_id, url, payload, digest, refers_to, revisit in zip(*columns):
                held += (b"" if held else lead) + encoder.compress(record_bytes(
                    page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py(), revisit.as_py()))
                if len(held) >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bytes(held)], pa.binary())], names=["archive"])
                    held = bytearray()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([bytes(held)], pa.binary())], names=["archive"])

    cols = records.select("page_id", "url", "payload", "payload_digest", "refers_to", "revisit")
    (ship(cols).mapInArrow(frames, "archive binary")
     .select(F.col("archive").cast("string").alias("value"))      # the bytes as they are; the text writer copies them
     .write.option("lineSep", EMPTY_FRAME.decode("ascii")).option("compression", "none")
     .option("maxRecordsPerFile", 1).text(path))


READ_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, archive string, position long, error string")


def read_archives(spark: SparkSession, path: str, strict: bool = False, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives under ``path`` (optionally with its payload).

    Spark reads each archive whole, so an archive's size bounds a task's memory.
    """
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")] + (["payload"] if payloads else [])
    schema = READ_SCHEMA + (", payload binary" if payloads else "")

    def records(it):
        types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "position": pa.int64(),
                 "payload": pa.binary()}
        for batch in it:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for position, raw, error in archive_records(content.as_buffer()):
                    facts = {}
                    if error is None:
                        try:
                            facts = parse_record(raw)
                        except BadRecord as e:
                            error = str(e)
                    if error and strict:
                        raise BadRecord(f"{archive.as_py()} at {position}: {error}")
                    rows.append({**facts, "archive": archive.as_py(), "position": position, "error": error})
                    if len(rows) == 512:
                        yield _batch(rows, names, types)
                        rows = []
                if rows:
                    yield _batch(rows, names, types)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return ship(files).mapInArrow(records, schema)


def _batch(rows: list[dict], names: list[str], types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(n) for r in rows], types.get(n, pa.string())) for n in names], names=names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every page into archives and back."""
    records = with_revisits(table(spark, sf_dir, "pages"))
    n = records.count()
    share = min(1.0, 1.2 * DICTIONARY_PAGES / max(1, n))
    sample = (records.filter(F.col("payload_bytes").between(1, 1 << 16)
                             & (unit_interval(F.lit("dictionary"), F.col("page_id"), F.col("payload_digest")) <= share))
              .select("payload").limit(DICTIONARY_PAGES))
    dictionary = train_dictionary([bytes(r[0]) for r in sample.collect()])
    path = scratch_path(spark, "warc")
    write_archives(records, path, dictionary)
    return read_archives(spark, path, strict=True).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
         octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
