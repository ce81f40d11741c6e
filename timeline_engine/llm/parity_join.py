"""Exact n-gram Jaccard join with parity sketches.

A document's set holds the 64-bit hashes of its distinct word shingles. For
sets of a size band [2^k, 2^(k+1)) a sketch has m = max(64, 2^k) chunks; a
shingle belongs to one chunk and is XORed into it, so each shingle in which
two sets differ changes at most one chunk: the number of unequal chunks
bounds the symmetric difference from below. Sets of sizes a and b with Jaccard
similarity >= 3/4 differ in at most d = a + b - 2 * ceil(3 (a + b) / 7)
shingles, hence agree in at least m - d chunks. If both keep their d + 1
foremost chunks in one common order, they share one of them (pigeonhole). The
order puts chunks of several shingles first, then those of one, then frequent
chunks (as passages shared by many texts make them), and empty ones last. A set
also emits its chunks in the band below if a partner may lie there.

Two scans of the texts: the first counts the chunk keys of all documents and
yields the frequent ones, the second emits each set's foremost keys. Keys
travel as packed arrays, one blob per hash bucket and Arrow batch, and are
sorted in numpy. The list of frequent keys has at most ``MOST_FREQUENT``
entries (the threshold rises if need be), so it can be broadcast; it only sets
an order, and any list gives the same links. Equal keys form a run of texts
(equal sets count once in a run). Candidates are filtered by size and by the
Hamming distance of a bit sketch (the parity of the shingles hashed to each
bit, four to eight bits a shingle), then verified on whole sets.

Links are only needed for classes. First each run is compared with its least
and greatest member and components of these links are formed. In runs of at
most ``SMALL`` members, the likeliest pair of each two components, and then all
pairs of different components are verified. Larger runs that still hold several
components are families of one template: ``families.py`` finds their links
without comparing all pairs. Every link between different texts is thereby found
or is implied by others.

A run is cut out of its bucket's keys in one task, at 12 bytes for each
different text that shares the chunk; copies of a text add nothing to it within
a batch. Whatever follows deals the members of a run to many tasks.

Nulls: a null or wordless text has an empty set and no links. A row with a null
doc_id links with nothing and its component is null. Rows that repeat a doc_id
are one node: what one of its texts links with, the others reach. Other columns
are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, delete_at_end, fresh_path, mix64, ngram_hashes, table, word_hashes, written
from .components import components, joined_components
from .families import SMALL, families, family_links

N_WORDS = 5
#: similarity >= 3/4, as integers
NUM, DEN = 3, 4
LEAST_CHUNKS = 64
BUCKET_BYTES = 24_000_000
#: Keys of a batch are flushed to blobs from this number on.
FLUSH_KEYS = 500_000
#: Rows of texts in one Arrow batch.
TEXT_ROWS = 2_000
#: A chunk key is frequent if more texts than this hold it.
FREQUENT = 16
MOST_FREQUENT = 2_000_000
#: Rows of whole sets in one Arrow batch.
SET_ROWS = 200
#: Bits of the map that marks nodes for verification.
MARKS = 1 << 26
_ROW = "bucket int, doc_id bigint, n bigint, f1 bigint, f2 bigint, sketch binary, blob binary"
_ARROW = pa.schema([("bucket", pa.int32()), *[(c, pa.int64()) for c in ("doc_id", "n", "f1", "f2")], ("sketch", pa.binary()), ("blob", pa.binary())])
_SET = ("doc_id", "n", "f1", "f2", "sketch")


def shingle_set(text: bytes | None, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text in UTF-8."""
    words = word_hashes((text or b"").lower())  # bytes: A-Z only
    if not len(words):
        return np.empty(0, np.uint64)
    s = np.sort(ngram_hashes(words, min(n, len(words))))
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def most_different(low: int, high: int) -> int:
    """The largest symmetric difference of similar sets whose sizes sum to
    something from ``low`` to ``high``."""
    return max((s - 2 * -(-NUM * s // (NUM + DEN)) for s in range(max(low, high - 13), high + 1)), default=0)


def _chunks(s: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, number of shingles, index) of the non-empty chunks of a band."""
    m = max(LEAST_CHUNKS, 1 << level)
    chunk = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    at = np.flatnonzero(np.diff(chunk, prepend=np.uint64(m)))
    value = np.bitwise_xor.reduceat(s, at)
    return mix64(value ^ mix64(chunk[at] + np.uint64(level << 40))), np.diff(at, append=len(s)), chunk[at]


def _bands(n: int) -> list[tuple[int, int]]:
    """(level, foremost chunks to emit) of a set of n shingles."""
    level = n.bit_length() - 1
    floor, least = 1 << level, -(-NUM * n // DEN)
    out = [(level, most_different(n + max(floor, least), n + DEN * n // NUM) + 1)]
    if least < floor:
        out.append((level - 1, most_different(n + least, n + floor - 1) + 1))
    return out


def _place(key: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket and 32 further bits of a key, as one number."""
    return ((key >> np.uint64(40)) % np.uint64(n_buckets)) << np.uint64(32) | key & np.uint64(0xFFFFFFFF)


def chunk_places(s: np.ndarray, n_buckets: int, frequent: np.ndarray | None) -> np.ndarray:
    """Places of the chunk keys by which a non-empty set meets its possible
    partners; all its keys if ``frequent`` is None."""
    out = []
    for level, keep in _bands(len(s)):
        key, size, chunk = _chunks(s, level)
        place = _place(key, n_buckets)
        if frequent is not None:
            if len(key) > keep:
                rank = (size == 1).astype(np.uint64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, place), len(frequent) - 1)
                    rank[frequent[at] == place] = 2
                place = place[np.argpartition(rank << np.uint64(62) | key >> np.uint64(2), keep - 1)[:keep]]
            elif len(key) < keep:
                empty = np.setdiff1d(np.arange(max(LEAST_CHUNKS, 1 << level), dtype=np.uint64), chunk)
                none = np.sort(mix64(mix64(empty + np.uint64(level << 40)) + np.uint64(1)))[: keep - len(key)]
                place = np.concatenate([place, _place(none, n_buckets)])
        out.append(place)
    return np.concatenate(out)


def parity_sketch(s: np.ndarray) -> bytes:
    """Bits, each the parity of the shingles hashed to it: 256 to 65,536, four
    to eight a shingle."""
    n_bits = 1 << min(max(len(s).bit_length() + 2, 8), 16)
    odd = np.bincount((s & np.uint64(n_bits - 1)).astype(np.intp), minlength=n_bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch of ``size`` bytes: halves of a parity sketch XOR to the shorter
    one."""
    x = np.frombuffer(sketch, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.view(np.uint64)


def allowed(total):
    """The largest symmetric difference of similar sets whose sizes sum to
    ``total``."""
    return total - 2 * -(-NUM * total // (NUM + DEN))


def _blobs(places: list[np.ndarray], ids: list[int] | None) -> pa.RecordBatch:
    """One row a bucket: the 32-bit parts of the places, then the ids."""
    place = np.concatenate(places)
    order = np.argsort(place >> np.uint64(32), kind="stable") if ids is not None else None
    place = place[order] if ids is not None else np.sort(place)
    bucket = (place >> np.uint64(32)).astype(np.int32)
    low = (place & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    f1 = np.repeat(np.array(ids, np.uint64), [len(p) for p in places])[order] if ids is not None else None
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts[1:], len(bucket))
    payload = [low[a:b].tobytes() + (f1[a:b].tobytes() if f1 is not None else b"") for a, b in zip(starts, ends, strict=True)]
    none = [pa.nulls(len(starts), pa.int64())] * 4
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *none, pa.nulls(len(starts), pa.binary()), pa.array(payload, pa.binary())], schema=_ARROW)


def _scan(n_buckets: int, frequent):
    """Blobs of all chunk keys, without ids, if ``frequent`` is None; else blobs
    of the foremost keys and a row that describes each set."""

    def run(batches):
        counting = frequent is None
        common = None if counting else frequent.value
        for batch in batches:
            rows, places, ids, size, seen = [], [], [], 0, set()
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                s = shingle_set(text.as_py())
                f1, f2 = int(np.bitwise_xor.reduce(s)) ^ len(s), int(np.add.reduce(s))
                if len(s) and doc_id is not None and (f1, f2) not in seen:
                    seen.add((f1, f2))
                    places.append(chunk_places(s, n_buckets, common))
                    ids.append(f1)
                    size += len(places[-1])
                if not counting:
                    rows.append((doc_id, len(s), f1, f2, parity_sketch(s)))
                if size >= FLUSH_KEYS:
                    yield _blobs(places, None if counting else ids)
                    places, ids, size = [], [], 0
            if places:
                yield _blobs(places, None if counting else ids)
            if rows:
                cols = list(zip(*rows, strict=True))
                f1, f2 = (np.array(c, np.uint64).view(np.int64) for c in cols[2:4])
                # These rows pass through their group: dealt by id, not by set.
                where = -1 - (mix64(np.array([i or 0 for i in cols[0]], np.int64).view(np.uint64)) % np.uint64(n_buckets)).astype(np.int32)
                arrays = [pa.array(where), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(f1), pa.array(f2)]
                arrays += [pa.array(cols[4], pa.binary()), pa.nulls(len(rows), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    return run


def _frequent(group: pa.Table) -> pa.Table:
    """Of a bucket's blobs of keys, those that more than FREQUENT texts hold."""
    names = {"place": pa.int64(), "texts": pa.int64()}
    if not len(group):
        return pa.table({k: pa.array([], t) for k, t in names.items()})
    low = np.sort(np.concatenate([np.frombuffer(b.as_buffer(), np.uint32) for b in group.column("blob")]))
    at = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    n = np.diff(at, append=len(low))
    often = n > FREQUENT
    place = low[at[often]].astype(np.int64) | (group.column("bucket")[0].as_py() << 32)
    return pa.table({"place": pa.array(place, pa.int64()), "texts": pa.array(n[often], pa.int64())})


def most_frequent(rows: DataFrame) -> np.ndarray:
    """Sorted places of the most frequent keys in ``rows``, blobs of keys
    without ids."""
    often = written(rows.select("bucket", "blob").groupBy("bucket").applyInArrow(_frequent, "place bigint, texts bigint"), "frequent")
    level = F.floor(F.log2("texts")).cast("int")
    sizes = sorted((r[0], r[1]) for r in often.groupBy(level).count().collect())
    least, room = 63, MOST_FREQUENT
    for k, n in reversed(sizes):
        if n > room:
            break
        least, room = k, room - n
    kept = often.where(level >= least).select("place").toArrow().column(0).to_numpy()
    return np.sort(kept).astype(np.uint64)


def _runs(group: pa.Table) -> pa.Table:
    """Of a bucket's blobs, the distinct runs of texts that share a key; rows
    that describe sets pass through."""
    if not len(group) or group.column("bucket")[0].as_py() < 0:
        return group
    keys, ids = [], []
    for blob in group.column("blob").to_pylist():
        n = len(blob) // 12
        keys.append(np.frombuffer(blob, np.uint32, n))
        ids.append(np.frombuffer(blob, np.uint64, n, offset=4 * n))
    key, f1 = np.concatenate(keys), np.concatenate(ids)
    order = np.argsort(key)
    key, f1 = key[order], f1[order]
    same = key[1:] == key[:-1]
    edge = np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))
    found = set()
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1, strict=True):
        members = np.unique(f1[a:b])
        if len(members) > 1:
            found.add(members.tobytes())
    found = sorted(found)
    none = [pa.nulls(len(found), pa.int64())] * 4
    return pa.Table.from_arrays([pa.nulls(len(found), pa.int32()), *none, pa.nulls(len(found), pa.binary()), pa.array(found, pa.binary())], schema=_ARROW)


def _members(ends_only: bool):
    """Runs as rows: of all members, or as pairs with the least and greatest."""

    def run(batches):
        for batch in batches:
            for run_id, blob in zip(batch.column(0), batch.column(1), strict=True):
                m = np.frombuffer(blob.as_py(), np.uint64).view(np.int64)
                if ends_only:
                    a = np.concatenate([np.repeat(m[0], len(m) - 1), np.repeat(m[-1], len(m) - 2)])
                    b = np.concatenate([m[1:], m[1:-1]])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(run_id.as_py(), len(m))), pa.array(m)], names=["run", "f1"])

    return run


def _marks(node: np.ndarray) -> np.ndarray:
    return (mix64(node.astype(np.int64).view(np.uint64)) % np.uint64(MARKS)).astype(np.int64)


def _partial_marks(batches):
    """A bitmap of the hashes of a partition's nodes, compressed."""
    marks = np.zeros(MARKS, bool)
    for batch in batches:
        marks[_marks(batch.column(0).to_numpy())] = True
    if marks.any():
        packed = zstandard.ZstdCompressor().compress(np.packbits(marks).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["marks"])


def _sets_again(marks):
    """The whole sets of documents, of marked ones only if ``marks`` is given."""

    def run(batches):
        held = None if marks is None else np.unpackbits(np.frombuffer(marks.value, np.uint8)).astype(bool)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if held is not None:
                batch = batch.filter(pa.array(held[_marks(batch.column(0).to_numpy())]))
            sets = [shingle_set(t.as_py()).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _verified(batches):
    for batch in batches:
        x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        ok = []
        for p, q in zip(x, y, strict=True):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = np.concatenate([p, q])
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            ok.append(DEN * common >= NUM * (len(p) + len(q) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])


def _close(batches):
    """Of pairs (a, b, sizes, sketches), those that size and sketches allow."""
    for batch in batches:
        a, b, n_a, n_b = (batch.column(k).to_numpy() for k in range(4))
        ok = DEN * np.minimum(n_a, n_b) >= NUM * np.maximum(n_a, n_b)
        for i in np.flatnonzero(ok):
            x, y = batch.column(4)[i].as_py(), batch.column(5)[i].as_py()
            size = min(len(x), len(y))
            ok[i] = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= allowed(int(n_a[i] + n_b[i]))
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])


def _open_pairs(best_only: bool):
    """From the members of small runs, sorted by run: pairs of unequal components
    that size and sketches allow. With ``best_only`` one pair for each two
    components, that of least distance."""

    def pairs(run: list[tuple], seen: dict):
        size = min(len(r[3]) for r in run)
        node, component, n = (np.array([r[k] for r in run], np.int64) for k in range(3))
        bits = np.stack([folded(r[3], size) for r in run])
        least, most = np.minimum(n[:, None], n), np.maximum(n[:, None], n)
        i, j = np.nonzero((node[:, None] < node) & (component[:, None] != component) & (DEN * least >= NUM * most))
        apart = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
        near = np.flatnonzero(apart <= allowed(n[i] + n[j]))
        i, j, apart = i[near], j[near], apart[near]
        for a, b, c, d, far in zip(node[i].tolist(), node[j].tolist(), component[i].tolist(), component[j].tolist(), apart.tolist(), strict=True):
            key = (min(c, d), max(c, d)) if best_only else (a, b)
            if key not in seen or seen[key][0] > far:
                seen[key] = (far, a, b)

    def out(seen: dict):
        _, a, b = zip(*seen.values(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        now, held, seen = None, [], {}
        for batch in batches:
            for run_id, *row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if run_id != now:
                    if len({r[1] for r in held}) > 1:
                        pairs(held, seen)
                    now, held = run_id, []
                    if len(seen) > 200_000:
                        yield out(seen)
                        seen = {}
                held.append(row)
        if len({r[1] for r in held}) > 1:
            pairs(held, seen)
        if seen:
            yield out(seen)

    return run


def _whole_sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of the documents in ``nodes``, and of a few others.

    Texts are not shuffled: a bitmap of fixed size that marks the nodes is
    broadcast, and marked documents are taken from a scan. Where the nodes are
    too many for it, a semi-join finds the texts.
    """
    nodes = written(nodes, "nodes")
    if nodes.count() > MARKS // 8:
        texts, marks = docs.join(nodes, "doc_id", "left_semi").select("doc_id", "text"), None
    else:
        both = np.zeros(MARKS // 8, np.uint8)
        parts = nodes.coalesce(4).mapInArrow(_partial_marks, "marks binary")
        for row in parts.toLocalIterator():
            both |= np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row[0])), np.uint8)
        texts, marks = docs.select("doc_id", "text"), docs.sparkSession.sparkContext.broadcast(both.tobytes())
    return written(texts.mapInArrow(_sets_again(marks), "node bigint, shingles binary"), "shingles")


def _linked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) of node ids that are similar, by whole sets."""
    nodes = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b"))).distinct()
    sets = _whole_sets(nodes, docs)
    x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    with arrow_rows(docs.sparkSession, SET_ROWS):
        linked = joined.mapInArrow(_verified, "a bigint, b bigint, linked boolean").where("linked").select("a", "b").distinct()
        return written(linked, "verified")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row a document."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        return _jaccard_components(docs)


def _jaccard_components(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(2 * shuffles, -(-n_bytes * 8 // (10 * BUCKET_BYTES)))
    frequent = spark.sparkContext.broadcast(most_frequent(docs.mapInArrow(_scan(n_buckets, None), _ROW)))
    scanned = docs.mapInArrow(_scan(n_buckets, frequent), _ROW)
    # Written once: sets and runs both come from this table.
    path = fresh_path(spark, "sets-and-runs")
    scanned.groupBy("bucket").applyInArrow(_runs, _ROW).write.parquet(path)
    delete_at_end(spark, path)
    both = spark.read.schema(_ROW).parquet(path)
    sets = both.where(F.col("blob").isNull()).select(*_SET)
    runs = both.where(F.col("blob").isNotNull()).select("blob").distinct().withColumn("run", F.xxhash64("blob"))
    runs = written(runs.select("run", "blob"), "runs")

    keys = ["f1", "f2", "n"]
    real = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = written(real.groupBy(*keys).agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")), "classes")

    # Sets by f1 alone: a clash of f1 only adds candidates.
    pairs = runs.mapInArrow(_members(True), "a bigint, b bigint").distinct()
    a, b = classes.alias("a"), classes.alias("b")
    near = pairs.alias("p").join(a, F.col("p.a") == F.col("a.f1")).join(b, F.col("p.b") == F.col("b.f1"))
    near = near.where(F.col("a.node") != F.col("b.node")).select("a.node", "b.node", "a.n", "b.n", "a.sketch", "b.sketch")
    near = near.toDF("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(_close, "a bigint, b bigint")
    first = written(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    found = components(_linked(first, docs))

    # The texts of a repeated doc_id are one node.
    one_set = F.struct(*keys)
    repeated = real.groupBy("doc_id").agg(F.min(one_set).alias("_lo"), F.max(one_set).alias("_hi")).where(F.col("_lo") != F.col("_hi"))
    repeated = written(repeated.select("doc_id"), "repeated-ids")
    if not repeated.isEmpty():
        one = real.join(repeated, "doc_id").select("doc_id", *keys).distinct().join(classes, keys)
        found = joined_components(found, one.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))

    # Small runs that hold several components: first the likeliest pair of each
    # two components, then whatever is still open. Both passes find few links.
    of_runs = lambda some: some.mapInArrow(_members(False), "run bigint, f1 bigint").join(classes, "f1")
    small = runs.where((F.octet_length("blob") > 16) & (F.octet_length("blob") <= 8 * SMALL))
    members = written(of_runs(small).select("run", "node", "n", "sketch"), "members")
    tried = first
    for best_only in (True, False):
        rows = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        rows = rows.select("run", "node", "component", "n", "sketch").repartition("run").sortWithinPartitions("run")
        later = rows.mapInArrow(_open_pairs(best_only), "a bigint, b bigint").distinct().join(tried, ["a", "b"], "left_anti")
        later = written(later, "later-pairs")
        if later.isEmpty():
            continue
        more = _linked(later, docs)
        if not more.isEmpty():
            found = joined_components(found, more)
        tried = tried.union(later)

    large = of_runs(runs.where(F.octet_length("blob") > 8 * SMALL)).select("run", "node").join(found, "node", "left")
    large = large.withColumn("component", F.coalesce("component", "node"))
    several = large.groupBy("run").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") < F.col("hi")).select("run")
    large = written(large.join(several, "run"), "large-runs")
    if not large.isEmpty():
        placed = written(families(large).join(large.select("node", "component").distinct(), "node"), "families")
        whole = _whole_sets(placed.select(F.col("node").alias("doc_id")), docs)
        rows = placed.join(whole, "node").select("family", "node", "component", F.floor(F.octet_length("shingles") / 8).alias("n"), F.col("shingles").alias("e"))
        links = family_links(rows, n_buckets, _place, _blobs, _ROW, most_frequent)
        if not links.isEmpty():
            found = joined_components(found, links)
    found = found.withColumnRenamed("component", "reached")
    placed = classes.select(*keys, "node").join(found, "node", "left").select(*keys, F.coalesce("reached", "node").alias("reached"))
    placed = placed.select(*[F.col(k).alias(f"_{k}") for k in keys], "reached")
    out = sets.join(placed, [F.col(k) == F.col(f"_{k}") for k in keys], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op6_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set, least doc_id it is linked to."""
    return jaccard_components(table(spark, sf_dir, "documents"))
