"""Similar pairs inside families: many texts of one template, exact, without
comparing all pairs.

A family is a group of sets that meet by chunks they share. Two sets of sizes a
and b are similar (Jaccard 3/4) exactly if 7 times their symmetric difference is
at most a + b. A difference doesn't change when both sets are taken apart from
a third one, so each set is replaced by its remainder, its symmetric difference
from the family's template (the shingles that most of a few members hold; any
set would be right, a good one makes remainders short). With s = 7 * (size of
the remainder) - (size of the set), two members are similar exactly if their
remainders share at least (s_x + s_y) / 14 shingles:

- If that is none, they are similar. Members with such a partner are linked to
  the member of least s, which is then one as well: a star, no pairs.
- Otherwise their remainders share a shingle among their first ones, in one
  common order, rare shingles first (prefix filter). How many are first depends
  on the pair: size - max(1, (s_x + s_y) / 14) + 1. Members of a family are
  therefore cut into ``BANDS`` bands of s, and a remainder's prefix is emitted
  for each band with the least s that a partner in that band has. Texts that
  differ only in parts of their own share nothing there and cost nothing more.

Members that share such a shingle for one pair of bands form a list. Members of
one list are compared inside tasks, in blocks of ``BLOCK`` by a product of
matrices, and only links that join components are emitted, at most one a member
and block. Where that would be more than ``PAIRS`` pairs a member, long lists
(texts of a template within the template) first become families of the next
level, with templates of their own, while that makes the families smaller. Every
link between different components is found or implied.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, mix64, written
from .components import components, stars

#: Runs and lists of at most so many members are compared as they are.
SMALL = 32
LEVELS = 3
#: Pairs a member that are compared without a further level.
PAIRS = 1_000
#: The next level must have at most this share of the members.
SMALLER = 0.75
#: Members from which a template is made.
SAMPLE = 64
BANDS = 8
#: Members of a block of a list.
BLOCK = 512
#: A family's rows are dealt to so many tasks where they meet its template.
SALTS = 8
#: Rows of whole sets in one Arrow batch.
SET_ROWS = 200
#: Keys of a batch are flushed to blobs from this number on.
FLUSH_KEYS = 500_000
#: Numbers of a matrix held at once.
MATRIX = 4_000_000
_ROWS = "family bigint, node bigint, component bigint, n bigint, s bigint, e binary"
_KEYS = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
_LIST = "a binary, b binary"


def families(lists: DataFrame) -> DataFrame:
    """(node, family) of the members of ``lists`` (run, node): lists that share
    a member are one family."""
    least = lists.groupBy("run").agg(F.min("node").alias("a"))
    joined = components(lists.join(least, "run").select("a", F.col("node").alias("b")).distinct())
    return joined.withColumnRenamed("component", "family")


def _template(group: pa.Table) -> pa.Table:
    """The shingles that more than half of a family's sample hold."""
    sets = [np.frombuffer(e, np.uint64) for e in group.column("e").to_pylist()]
    found, n = np.unique(np.concatenate(sets), return_counts=True)
    most = found[2 * n > len(sets)].tobytes()
    return pa.table({"family": group.column("family").slice(0, 1), "template": pa.array([most], pa.binary())})


def _remainders(batches):
    for batch in batches:
        e, t = (batch.column(k).to_pylist() for k in (4, 5))
        apart = [np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(y or b"", np.uint64), assume_unique=True) for x, y in zip(e, t, strict=True)]
        n = batch.column(3).to_numpy()
        s = 7 * np.array([len(x) for x in apart], np.int64) - n
        arrays = [*(batch.column(k) for k in range(4)), pa.array(s, pa.int64()), pa.array([x.tobytes() for x in apart], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["family", "node", "component", "n", "s", "e"])


def salted(rows: DataFrame, small: DataFrame) -> DataFrame:
    """``rows`` with the columns of their family's row in ``small``; a family's
    rows meet it in ``SALTS`` tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    x = rows.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return x.join(small.withColumn("_salt", salts), ["family", "_salt"]).drop("_salt")


def remainders(rows: DataFrame) -> DataFrame:
    """(family, node, component, n, s, e) of ``rows`` (family, node, component,
    n, e), with e the remainder from the family's template."""
    rank = F.row_number().over(Window.partitionBy("family").orderBy(F.xxhash64("node"), "node"))
    sample = rows.select("family", "node").withColumn("_k", rank).where(F.col("_k") <= SAMPLE).drop("_k")
    chosen = rows.join(sample, ["family", "node"]).select("family", "e")
    templates = written(chosen.groupBy("family").applyInArrow(_template, "family bigint, template binary"), "templates")
    met = salted(rows.select("family", "node", "component", "n", "e"), templates).select("family", "node", "component", "n", "e", "template")
    with arrow_rows(rows.sparkSession, SET_ROWS):
        return written(met.mapInArrow(_remainders, _ROWS), "remainders")


def needed(s: int, least: int) -> int:
    """Shingles that a remainder shares, at least, with that of a partner that
    is not similar anyway and whose s is ``least`` or more."""
    return max(1, -(-(s + least) // 14))


def banded(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(star links (a, b); rows with ``component`` as the star leaves it, ``band``,
    and ``bands``: (band, least s, component if it holds one only) of all bands
    of the family)."""
    shares = F.array(*[F.lit(k / BANDS) for k in range(1, BANDS)])
    first = rows.groupBy("family").agg(F.min(F.struct("s", "node", "component")).alias("_m"), F.percentile_approx("s", shares, 200).alias("bounds"))
    first = written(first.select("family", F.col("_m.s").alias("least"), F.col("_m.node").alias("first"), F.col("_m.component").alias("of_first"), "bounds"), "least-apart")
    met = salted(rows, first)
    near = F.col("s") + F.col("least") <= 0
    links = met.where(near & (F.col("component") != F.col("of_first"))).select(F.col("first").alias("a"), F.col("node").alias("b"))
    band = F.size(F.filter("bounds", lambda x: x < F.col("s")))
    met = met.withColumn("component", F.when(near, F.col("of_first")).otherwise(F.col("component"))).withColumn("band", band)
    met = written(met.select("family", "node", "component", "s", "e", "band"), "banded")
    one = F.when(F.min("component") == F.max("component"), F.min("component")).alias("one")
    bands = met.groupBy("family", "band").agg(F.min("s").alias("least"), one)
    bands = bands.groupBy("family").agg(F.array_sort(F.collect_list(F.struct("band", "least", "one"))).alias("bands"))  # at most BANDS a family
    return written(links.distinct(), "stars"), salted(met, written(bands, "bands"))


def _counted(n_buckets: int, place, blobs):
    """Blobs of the keys of all shingles of remainders, to find frequent ones."""

    def run(batches):
        for batch in batches:
            places, size = [], 0
            for family, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                places.append(place(_keys(family, np.frombuffer(e, np.uint64)), n_buckets))
                size += len(places[-1])
                if size >= FLUSH_KEYS:
                    yield blobs(places, None)
                    places, size = [], 0
            if size:
                yield blobs(places, None)

    return run


def _keys(family: int, e: np.ndarray) -> np.ndarray:
    return mix64(e ^ mix64(np.array([family], np.int64).view(np.uint64)))


def _prefixes(n_buckets: int, frequent, place):
    """Blobs (32 bits of the key, node, side) a bucket: for each band, the keys
    of a remainder's first shingles; side 0 or 1 tells the lower of two bands
    from the higher, 2 is one band with itself."""

    def blobs(parts):
        at, node, side = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(at >> np.uint64(32), kind="stable")
        at, node, side = at[order], node[order], side[order]
        bucket = (at >> np.uint64(32)).astype(np.int32)
        low = (at & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(starts[1:], len(bucket))
        made = [low[x:y].tobytes() + node[x:y].tobytes() + side[x:y].tobytes() for x, y in zip(starts, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(made, pa.binary())], schema=_KEYS)

    def run(batches):
        for batch in batches:
            parts, size = [], 0
            for family, node, component, s, e, band, bands in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                key = _keys(family, np.frombuffer(e, np.uint64))
                rank = np.zeros(len(key), np.uint64)
                if len(frequent.value) and len(key):
                    at = place(key, n_buckets)
                    where = np.minimum(np.searchsorted(frequent.value, at), len(frequent.value) - 1)
                    rank[frequent.value[where] == at] = 1
                key = key[np.argsort(rank << np.uint64(62) | key >> np.uint64(2))]
                for other in bands:
                    keep = len(key) - needed(s, other["least"]) + 1
                    if keep <= 0 or other["one"] == component:
                        continue
                    lo, hi = min(band, other["band"]), max(band, other["band"])
                    at = place(mix64(key[:keep] + np.uint64(lo * BANDS + hi + 1)), n_buckets)
                    side = 2 if lo == hi else int(band == hi)
                    parts.append((at, np.full(keep, node, np.int64), np.full(keep, side, np.uint8)))
                    size += keep
                if size >= FLUSH_KEYS:
                    yield blobs(parts)
                    parts, size = [], 0
            if parts:
                yield blobs(parts)

    return run


def _lists(group: pa.Table) -> pa.Table:
    """Of a bucket's blobs, the distinct lists (a, b): the members of the lower
    and the higher band; without b, those of one band."""
    columns = [[], [], []]
    for blob in group.column("blob").to_pylist():
        n = len(blob) // 13
        for held, kind, at in zip(columns, (np.uint32, np.int64, np.uint8), (0, 4 * n, 12 * n), strict=True):
            held.append(np.frombuffer(blob, kind, n, offset=at))
    found = set()
    if columns[0]:
        low, node, side = map(np.concatenate, columns)
        order = np.argsort(low)
        low, node, side = low[order], node[order], side[order]
        same = low[1:] == low[:-1]
        edge = np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))
        for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1, strict=True):
            nodes, sides = node[x:y], side[x:y]
            if (sides == 2).any():
                a, b = np.unique(nodes), nodes[:0]
            else:
                a, b = np.unique(nodes[sides == 0]), np.unique(nodes[sides == 1])
                if not len(a) or not len(b):
                    continue
            if len(a) + len(b) > 1:
                found.add((a.tobytes(), b.tobytes()))
    found = sorted(found)
    return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})


def _dealt(batches):
    """Members of lists by pairs of blocks: (run, i, j, node, second)."""
    for batch in batches:
        for run_id, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            a, b = np.frombuffer(a or b"", np.int64), np.frombuffer(b or b"", np.int64)
            alone = not len(b)
            rows, columns = ([m[k : k + BLOCK] for k in range(0, len(m), BLOCK)] for m in (a, a if alone else b))
            for i, x in enumerate(rows):
                for j, y in enumerate(columns):
                    if alone and j < i:
                        continue
                    y = y[:0] if alone and i == j else y
                    k = len(x) + len(y)
                    each = [np.repeat(run_id, k), np.repeat(i, k), np.repeat(j, k), np.concatenate([x, y]), np.arange(k) >= len(x)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in each], names=["run", "i", "j", "node", "second"])


def shared(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """How many elements each set of ``rows`` shares with each of ``columns``
    (places in ``sets``), by products of matrices over elements held twice."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    twice = times[at] > 1
    owner, at = owner[twice], number[at[twice]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(rows), len(columns)), np.float32)
    n = int(at[-1]) + 1 if len(at) else 0
    width = max(1, min(n, MATRIX // len(sets)))
    for lo in range(0, n, width):
        x, y = np.searchsorted(at, [lo, lo + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[x:y], at[x:y] - lo] = 1
        out += held[rows] @ held[columns].T
    return out.astype(np.int64)


def _compared(batches):
    """Links that join components, of members sorted by (run, i, j)."""

    def links(held):
        node, component, second, s, e = zip(*held, strict=True)
        component, s = np.array(component, np.int64), np.array(s, np.int64)
        second = np.array(second, bool)
        x, y = (np.flatnonzero(~second), np.flatnonzero(second)) if second.any() else (np.arange(len(node)),) * 2
        apart = component[x][:, None] != component[y]
        if not apart.any():
            return
        common = shared([np.frombuffer(v, np.uint64) for v in e], x, y)
        a, b = np.nonzero(apart & (14 * common >= s[x][:, None] + s[y]))
        if len(a):
            node = np.array(node, np.int64)
            u, v = stars(node[x[a]], node[y[b]])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["a", "b"])

    now, held = None, []
    for batch in batches:
        for run_id, i, j, *row in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
            if (run_id, i, j) != now:
                if len(held) > 1:
                    yield from links(held)
                now, held = (run_id, i, j), []
            held.append(row)
    if len(held) > 1:
        yield from links(held)


def _members(batches):
    """Lists as rows (run, node)."""
    for batch in batches:
        for run_id, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            m = np.frombuffer((a or b"") + (b or b""), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(run_id, len(m))), pa.array(m)], names=["run", "node"])


def compared(lists: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) inside ``lists`` (run, a, b) of ``rows`` (node, component, s, e)."""
    cells = ["run", "i", "j"]
    dealt = lists.mapInArrow(_dealt, "run bigint, i bigint, j bigint, node bigint, second boolean").join(rows, "node")
    dealt = dealt.select(*cells, "node", "component", "second", "s", "e").repartition(*cells).sortWithinPartitions(*cells)
    with arrow_rows(rows.sparkSession, SET_ROWS):
        return written(dealt.mapInArrow(_compared, "a bigint, b bigint").distinct(), "family-links")


def family_links(rows: DataFrame, n_buckets: int, place, blobs, row_schema: str, frequent_of) -> DataFrame:
    """Links (a, b) between different components of ``rows`` (family, node,
    component, n, e), enough for the classes. ``place``, ``blobs``,
    ``row_schema`` and ``frequent_of`` are the key tools of the calling join."""
    spark, links = rows.sparkSession, None
    for level in range(LEVELS):
        rows = remainders(rows)
        star, placed = banded(rows)
        with arrow_rows(spark, SET_ROWS):
            counted = rows.select("family", "e").mapInArrow(_counted(n_buckets, place, blobs), row_schema)
            frequent = spark.sparkContext.broadcast(frequent_of(counted))
            asked = placed.select("family", "node", "component", "s", "e", "band", "bands")
            keys = asked.mapInArrow(_prefixes(n_buckets, frequent, place), "bucket int, blob binary")
            lists = keys.groupBy("bucket").applyInArrow(_lists, _LIST).distinct()
            lists = written(lists.select(F.xxhash64("a", "b").alias("run"), "a", "b"), "lists")
        named = rows.select("node", "component", "s", "e")
        a, b = (F.octet_length(c).cast("double") / 8 for c in "ab")
        long, nested = a + b > SMALL, None
        pairs = lists.where(long).agg(F.coalesce(F.sum(F.when(b > 0, a * b).otherwise(a * a / 2)), F.lit(0.0))).first()[0]
        if level < LEVELS - 1 and pairs > PAIRS * rows.count():
            members = lists.where(long).mapInArrow(_members, "run bigint, node bigint").join(named.select("node", "component"), "node")
            several = members.groupBy("run").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") < F.col("hi")).select("run")
            nested = written(families(members.join(several, "run").select("run", "node")), "families")
            if nested.isEmpty() or nested.count() > SMALLER * rows.count():
                nested = None
        found = star.union(compared(lists if nested is None else lists.where(~long), named))
        links = found if links is None else links.union(found)
        if nested is None:
            break
        rows = rows.select("node", "component", "n", "e").join(nested, "node").select("family", "node", "component", "n", "e")
    return links
