"""WARC archives compressed with a dictionary (.warc.zst).

Every archive starts with a skippable frame (magic 0x184D2A5D) that embeds a
Zstandard dictionary built from the archive's own records; each record follows
as a frame of its own, so any record can be decompressed alone. Equal payloads
are stored once: the page of smallest id is a response record, the others are
revisit records that refer to it.

Writers stream: a task holds at most one archive (``ARCHIVE_BYTES`` of
records). Spark itself writes the archives, a file each, to whatever store it
knows, and its commit protocol shows those of finished tasks only. Its text
writer serves for that: it writes a string's bytes as they are, and ends each
file with a separator, for which an empty skippable frame is given, so that the
file stays a valid Zstandard stream. A task that runs again makes the same
archives from the same rows in the same order. The committed files are listed in
a table; readers that are given it open no others, so whatever else lies in the
folder is never read.

Duplicates are found with digests alone (a combined minimum per digest); only
pages that have a copy take part in the join that tells them so.

Nulls: null html is an empty payload; a null url leaves the target field out; a
null page_id is written as ``none`` and is never the page referred to. Of rows
that repeat a page_id and payload, one (of least url, nulls first) is the
response if that id is the smallest, and the others revisit it. An empty table gives no archives and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import delete_at_end, fresh_path, table, written

MAGIC = 0x184D2A5D
#: An empty skippable frame (magic 0x184D2A50, size 0): follows every archive.
END_FRAME = "P*M\x18\0\0\0\0"
LEAST_PAYLOAD = 100
ARCHIVE_BYTES = 16_000_000
DICTIONARY_BYTES = 64 * 1024
#: Bytes of records from which a dictionary is built, and of one record in it.
SAMPLE_BYTES, SAMPLE_RECORD = 3_000_000, 32_000
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # capture times are not part of the tables
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").removeprefix("urn:page:")
    return int(name) if name and name != "none" else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(chr(c) for c in range(33, 127) if chr(c) != "%") + "%")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary trained on evenly spaced records; where they are too few or
    too uniform to train on, one of the starts of these records as they are.
    None without records."""
    step = max(1, sum(min(len(r), SAMPLE_RECORD) for r in records) // SAMPLE_BYTES)
    sample = [r[:SAMPLE_RECORD] for r in records[::step]]
    if len(sample) >= 16:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8, f=18, level=LEVEL)
        except zstandard.ZstdError:  # too little or too uniform to train on
            pass
    each = DICTIONARY_BYTES // max(1, len(sample))
    starts = b"".join(r[: max(each, 1)] for r in sample)[:DICTIONARY_BYTES]
    return zstandard.ZstdCompressionDict(starts, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(starts) >= 8 else None


def archive(records: list[bytes]) -> bytes:
    """The bytes of a .warc.zst file."""
    dictionary = build_dictionary(records)
    raw = dictionary.as_bytes() if dictionary else b""
    if dictionary and not dictionary.dict_id():  # starts of records: embedded compressed
        raw = zstandard.ZstdCompressor(level=LEVEL).compress(raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True) if dictionary else zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    return struct.pack("<II", MAGIC, len(raw)) + raw + b"".join(packer.compress(r) for r in records)


def read_archive(data: bytes):
    """Yields (headers, block) of each record of a .warc.zst file."""
    dictionary, at = None, 0
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        raw, at = data[8 : 8 + size], 8 + size
        if raw[:4] == zstandard.FRAME_HEADER:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
    unpack = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    stream = io.BufferedReader(unpack.stream_reader(io.BytesIO(memoryview(data)[at:]), read_across_frames=True), 1 << 16)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        yield headers, block


def _archives(batches):
    """The records of a partition as archives."""
    kept, size = [], 0
    for batch in batches:
        for page_id, url, html, digest, refers_to in zip(*(batch.column(k) for k in range(5)), strict=True):
            payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
            kept.append(record(page_id.as_py(), url.as_py(), payload, digest.as_py(), refers_to.as_py()))
            size += len(kept[-1])
            if size >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_pydict({"archive": pa.array([archive(kept)], pa.binary())})
                kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_pydict({"archive": pa.array([archive(kept)], pa.binary())})


def _records(data: bytes):
    """The records of an archive, in batches."""
    names = [c.split()[0] for c in _RECORD.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    rows, size = [], 0
    for headers, block in read_archive(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        if headers["warc-type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"damaged payload in {headers['warc-record-id']}")
        whole = payload if headers["warc-type"] == "response" else None
        rows.append((_page(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], _page(headers.get("warc-refers-to")), digest, length, whole))
        size += len(payload)
        if size >= 16_000_000:
            yield out(rows)
            rows, size = [], 0
    if rows:
        yield out(rows)


def with_copies(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to); ``refers_to`` is null for pages
    that become response records."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).alias("n"))
    long = rows.where(F.col("n") >= LEAST_PAYLOAD).select("page_id", "digest")
    again = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    copies = long.join(again.select("digest", "first"), "digest").where(~F.col("page_id").eqNullSafe(F.col("first"))).distinct()
    copies = copies.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), F.col("first").alias("refers_to"))
    joined = rows.join(copies, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    repeated = long.where(F.col("page_id").isNotNull()).groupBy("page_id", "digest").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
    repeated = written(repeated.select("page_id", "digest"), "repeated-pages")
    out = joined.select("page_id", "url", "html", "digest", "refers_to")
    if repeated.isEmpty():
        return out
    # Only pages that repeat an id and payload are put in order.
    again = out.join(repeated, ["page_id", "digest"], "left_semi")
    later = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url")) > 1
    again = again.withColumn("_later", later).withColumn("refers_to", F.when(F.col("_later"), F.coalesce("refers_to", "page_id")).otherwise(F.col("refers_to")))
    return out.join(repeated, ["page_id", "digest"], "left_anti").select(*out.columns).unionByName(again.select(*out.columns))


def _files(spark: SparkSession, folder: str, names: str = "*.{txt,warc.zst}") -> DataFrame:
    """(name, bytes, content) of the archives in a folder, whoever wrote them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder)
    return files.select(F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("bytes"), "content")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes all pages to a new folder; returns (name, bytes) of the archives."""
    rows = with_copies(pages).sortWithinPartitions("page_id", "digest", "url", "refers_to")
    made = rows.mapInArrow(_archives, "archive binary").select(F.col("archive").cast("string").alias("archive"))
    made.write.option("lineSep", END_FRAME).option("maxRecordsPerFile", 1).text(folder)
    return written(_files(pages.sparkSession, folder).where(F.col("bytes") > 0).select("name", "bytes"), "archives")


def _read(batches):
    for batch in batches:
        for data in batch.column(0):
            yield from _records(data.as_py())


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in a folder, whoever wrote them."""
    return _files(spark, folder).select("content").mapInArrow(_read, _RECORD)


def read_named(archives: DataFrame, folder: str) -> DataFrame:
    """The records of the archives that one job wrote to a folder, by its
    ``archives``: the names of one job's files share an identifier."""
    one = archives.select("name").first()
    job = re.fullmatch(r"part-\d+-(.+)-c\d+\.txt", one[0])[1] if one else "none"
    return _files(archives.sparkSession, folder, f"part-*-{job}-c*.txt").select("content").mapInArrow(_read, _RECORD)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Writes the pages as archives, reads these back: a row per record."""
    folder = fresh_path(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), folder)
    delete_at_end(spark, folder)
    return read_named(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
"""
