"""Document fingerprints by winnowing.

Hashes of all ``K``-code-point grams are taken by a rolling (doubling) scheme;
in every window of ``WINDOW`` consecutive grams the smallest hash is selected,
the rightmost of equal ones, and a hash selected again at the same place counts
once. Any passage of at least ``WINDOW + K - 1`` code points that two texts
share therefore selects a hash in both, and the positions, which the fingerprint
holds beside the hashes, say where it lies in either (``located``). A text with
fewer grams than a window selects its smallest hash; one shorter than a
gram is hashed whole; the empty text has an empty fingerprint.

The likeness of two fingerprints is the Jaccard similarity of their sets of
hashes (1 for two empty ones).

``neighbours`` hands each document the text of the next one by doc_id without
a global sort: buckets of consecutive rows by (doc_id, hash of the text), sorted
each, with the first document of a bucket sent to the bucket before as well.
Bounds come from quantiles of doc_id, which only balance the load; an id that
fills several quantiles, or null, is cut further by the hash. Texts cross the
network once, compressed.

Nulls: a null text is empty; a null doc_id precedes all others. Rows that
repeat a doc_id are ordered by a hash of their text. In a table of one document
it is its own next. An empty table gives an empty table. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, table

K = 16  # a power of two, for the doubling
WINDOW = 32  # a power of two; shared passages of 47 code points are found
DOCS_PER_BUCKET = 4000
MOST_BUCKETS = 20_000
#: Bytes of text in a partition, where there are more than the session's number.
PARTITION_BYTES = 256_000_000
_NO_POSITION = np.uint64(0xFFFFFFFF)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Unsigned 32-bit hashes of all K-grams of code points."""
    h = mix64(codes.astype(np.uint64) + np.uint64(1))
    width, power = 1, 0x9E3779B97F4A7C15
    while width < K:
        h = h[:-width] * np.uint64(power) + h[width:]
        width *= 2
        power = power * power % 2**64
    return mix64(h) >> np.uint64(32)


def select(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the selected grams, by position."""
    # The smaller value wins; of equal hashes the larger position.
    key = (hashes << np.uint64(32)) | (_NO_POSITION - np.arange(len(hashes), dtype=np.uint64))
    width = 1
    while width < WINDOW and len(key) > width:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < WINDOW and len(key):
        key = key.min(keepdims=True)
    key = key[np.flatnonzero(np.diff(key, prepend=~key[:1]))] if len(key) else key
    return key >> np.uint64(32), _NO_POSITION - (key & _NO_POSITION)


def winnow(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of a text's fingerprint."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    if len(codes) < K:
        whole = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 32
        return np.array([whole], np.uint64), np.zeros(1, np.uint64)
    return select(gram_hashes(codes))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two arrays of distinct sorted hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(a) + len(b) - common)


def as_string(hashes: np.ndarray, positions: np.ndarray) -> str:
    """The fingerprint as text: 16 hexadecimal digits a gram, eight of its hash
    and eight of its position, in text order."""
    return np.stack([hashes, positions], 1).astype(">u4").tobytes().hex()


def from_string(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of a fingerprint given as text."""
    both = np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def located(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Where two fingerprints meet: (position in a, position in b) of every
    hash that both hold."""
    places: dict[int, list[int]] = {}
    for h, p in zip(b[0].tolist(), b[1].tolist(), strict=True):
        places.setdefault(h, []).append(p)
    return [(p, q) for h, p in zip(a[0].tolist(), a[1].tolist(), strict=True) for q in places.get(h, ())]


_FIRST, _HASHES = -(1 << 63), 1 << 63


def _cut(doc_id: int | None, parts: int) -> list[tuple]:
    """Bounds that part the rows of one doc_id by their hash."""
    return [(doc_id is not None, doc_id or 0, _FIRST + 2 * _HASHES * k // parts) for k in range(1, parts)]


def _bounds(docs: DataFrame, n: int, n_buckets: int) -> list[tuple]:
    """Sorted first rows of all buckets but the first, as (has id, id, hash)."""
    shares = [k / n_buckets for k in range(1, n_buckets)]
    found, no_id = docs.agg(F.percentile_approx("doc_id", shares, 10 * n_buckets), F.count_if(F.col("doc_id").isNull())).first()
    times = Counter(found or [])
    out = _cut(None, -(-no_id * n_buckets // n)) if no_id * n_buckets > n else []
    for doc_id, k in times.items():
        out += [(True, doc_id, _FIRST), *_cut(doc_id, k)]
    return sorted(out)


def _buckets(bounds: list[tuple], heads: dict[int, tuple] | None):
    """Rows (bucket, part, doc_id, text_hash, packed text) for the shuffle; with
    ``heads`` (bucket -> its first row) first documents are sent to the bucket
    before too, as part 1."""
    before: dict[tuple, list[int]] = {}
    order = sorted(heads or ())
    for k, b in enumerate(order):  # the bucket before the first is the last
        before.setdefault(heads[b], []).append(order[k - 1])

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = [(i is not None, i or 0, h) for i, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            at = [bisect_right(bounds, r) for r in rows]
            if heads is None:
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns[:2]], names=["bucket", "doc_id", "text_hash"])
                continue
            out = []
            for bucket, row, text in zip(at, rows, batch.column(2).cast(pa.binary()), strict=True):
                made = (row[1] if row[0] else None, row[2], packer.compress(text.as_py() or b""))
                out.append((bucket, 0, *made))
                if row in before and heads[bucket] == row:
                    out += [(b, 1, *made) for b in before[row]]
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["bucket", "part", "doc_id", "text_hash", "packed"])

    return run


def neighbours(docs: DataFrame) -> DataFrame:
    """(bucket, part, doc_id, text_hash, packed), sorted inside partitions so
    that each part-0 row is followed by its next document. The last document's
    next is the first."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    n, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_buckets = max(1, min(MOST_BUCKETS, n // DOCS_PER_BUCKET))
    bounds = _bounds(docs, n, n_buckets) if n_buckets > 1 else []
    # At most some MOST_BUCKETS rows of two numbers reach the driver.
    keys = docs.select("doc_id", "text_hash").mapInArrow(_buckets(bounds, None), "bucket int, doc_id bigint, text_hash bigint")
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash"))
    heads = {r[0]: tuple(r[1]) for r in keys.groupBy("bucket").agg(first.alias("head")).collect()}
    schema = "bucket int, part int, doc_id bigint, text_hash bigint, packed binary"
    rows = docs.mapInArrow(_buckets(bounds, heads), schema)
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(len(bounds) + 1, max(shuffles, (n_bytes or 0) // PARTITION_BYTES))
    return rows.repartition(max(1, parts), "bucket").sortWithinPartitions("bucket", "part", "doc_id", "text_hash")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _fingerprints(batches):
    unpack = zstandard.ZstdDecompressor()

    def texts():
        for batch in batches:
            for bucket, part, doc_id, packed in zip(*(batch.column(k) for k in (0, 1, 2, 4)), strict=True):
                yield bucket.as_py(), part.as_py(), doc_id.as_py(), unpack.decompress(packed.as_py()).decode("utf-8", "surrogatepass")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def packed_rows(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    rows, held, size = [], None, 0
    for bucket, part, doc_id, text in texts():
        now = (bucket, part, doc_id, text, *winnow(text))
        if held is not None and held[0] == bucket and held[1] == 0:
            changed = edited(held[3], text)
            h, p = winnow(changed)
            own, other, following = np.unique(held[4]), np.unique(h), np.unique(now[4])
            digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            rows.append((held[2], len(held[3]), digest, as_string(held[4], held[5]), as_string(h, p), likeness(own, other), likeness(own, following)))
            size += len(changed)
        held = now
        if size > 8_000_000:
            yield packed_rows(rows)
            rows, size = [], 0
    if rows:
        yield packed_rows(rows)


def op5_winnowing(spark, sf_dir: str) -> DataFrame:
    """Per document: fingerprints of the text and of its edited form, and the
    likeness to the edited form and to the next document."""
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return neighbours(table(spark, sf_dir, "documents")).mapInArrow(_fingerprints, schema)
