"""Exact centroid clustering with Drake's adaptive bounds.

Vectors are integers (floor(256 * x)), so distances, sums and means are exact.
With each vector go its centroid, an upper bound of the distance to it, its
next ``b`` nearest centroids in order with a lower bound each, and one lower
bound for the remainder. When centroids move, each bound moves by its
centroid's shift, the remainder's by the largest shift. A round then decides,
batch by batch in numpy:

1. the upper bound lies below all lower bounds: the assignment is certain;
2. else the distance to the own centroid is made exact and compared again;
3. else the listed centroids up to the first bound that certifies the rest are
   measured exactly and put in order anew;
4. if the remainder's bound doesn't certify, all centroids are measured.

A bound certifies only if it is strictly farther, so equal distances are always
measured, and the smaller number wins. Bounds are single floats rounded away
from certainty. ``b`` starts at a quarter of the centroids and adapts: the next
round lists one more than the deepest place that this round had to look at, at
least an eighth.

Scale: each round is one pass without a shuffle, from the table of vectors and
bounds to the next one; the table before is then deleted, so two exist at a
time. A task adds up its vectors by cluster, so at most clusters x components
numbers a task are shuffled, and a cluster with any share of the vectors fills
no task. Centroids (clusters x components integers, a fixed bound) are what the
driver holds and broadcasts. A lost executor repeats its part of one round.

Nulls: a null vector, one of another length, or with a null or non-finite
component is left out. A vector without vec_id is clustered but starts no
centroid; of rows that repeat a vec_id each is a vector, and those of least
components start first. With fewer vectors than clusters each starts one. A
component beyond 2^27 counts as 2^27, so that distances fit in a long. Other
columns are ignored. No vector at all gives an empty table.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete_at_end, delete_now, fresh_path, table

SCALE = 256
#: Components are cut at this size.
MOST = 1 << 27
#: float64 products of integers are exact while sums stay below 2^53.
EXACT_FLOAT = 1 << 22
_STATE = "vec_id bigint, vector array<int>, cluster int, distance bigint, upper float, near array<int>, lower array<float>, rest float, depth int, total_cluster int, total_component int, total bigint, total_rows bigint"


def integer_vectors(rows: DataFrame, size: int) -> DataFrame:
    """(vec_id, vector): the vectors of ``size`` finite components, as integers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = rows.where((F.size("embedding") == size) & F.forall("embedding", finite))
    whole = lambda x: F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))).cast("int")
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", whole).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of least digest of their vec_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    known = vectors.where(F.col("vec_id").isNotNull()).select(digest.alias("digest"), "vector")
    rows = known.orderBy("digest", "vector").limit(k).collect()
    return np.array([r[1] for r in rows], np.int64)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all rows of ``c``, exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if most < EXACT_FLOAT and 4 * most * most * x.shape[1] < 1 << 53:
        p, q = x.astype(np.float64), c.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2.0 * (p @ q.T) + (q * q).sum(1)).astype(np.int64)
    return np.stack([((x - one) ** 2).sum(1) for one in c], 1)


def up(x: np.ndarray) -> np.ndarray:
    """Single floats not below ``x``."""
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def down(x: np.ndarray) -> np.ndarray:
    """Single floats not above ``x``."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def ordered(d: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per row the places of the entries by distance, then by number."""
    by_id = np.argsort(ids, 1, kind="stable")
    return np.take_along_axis(by_id, np.argsort(np.take_along_axis(d, by_id, 1), 1, kind="stable"), 1)


class Bounds:
    """The bounds of a batch of vectors: ``cluster``, ``upper``, ``near`` and
    ``lower`` (b entries a vector), ``rest``; ``depth`` is how many of the
    listed centroids had to be looked at."""

    def __init__(self, cluster, upper, near, lower, rest):
        self.cluster, self.upper, self.near, self.lower, self.rest = cluster, upper, near, lower, rest
        self.depth = np.zeros(len(cluster), np.int32)

    @classmethod
    def unknown(cls, n: int, b: int) -> Bounds:
        """Bounds that certify nothing."""
        none = np.full(n, -np.inf, np.float32)
        return cls(np.zeros(n, np.int32), -none, np.zeros((n, b), np.int32), np.full((n, b), -np.inf, np.float32), none.copy())

    def move(self, shift: np.ndarray) -> None:
        """Centroids have moved by ``shift``."""
        self.upper = up(self.upper.astype(np.float64) + shift[self.cluster])
        self.lower = down(self.lower.astype(np.float64) - shift[self.near])
        self.rest = down(self.rest.astype(np.float64) - shift.max(initial=0.0))

    def rank(self, at: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        """Vectors ``at`` have exact distances ``found`` to the centroids
        ``ids``: the nearest becomes theirs, the others the first of the list."""
        order = ordered(found, ids)
        ids, root = np.take_along_axis(ids, order, 1), np.sqrt(np.take_along_axis(found, order, 1).astype(np.float64))
        self.cluster[at], self.upper[at] = ids[:, 0], up(root[:, 0])
        listed = min(self.near.shape[1], ids.shape[1] - 1)
        self.near[at, :listed], self.lower[at, :listed] = ids[:, 1 : listed + 1], down(root[:, 1 : listed + 1])
        if ids.shape[1] > listed + 1:
            self.rest[at] = down(root[:, listed + 1])

    def assign(self, x: np.ndarray, c: np.ndarray) -> None:
        """Makes every vector's centroid the nearest one."""
        b = self.near.shape[1]
        # The least bound from each place of the list on, the remainder's last.
        tail = np.minimum.accumulate(np.column_stack([self.lower, self.rest])[:, ::-1], 1)[:, ::-1]
        open_ = np.flatnonzero(self.upper >= tail[:, 0])
        if not len(open_):
            return
        own = ((x[open_] - c[self.cluster[open_]]) ** 2).sum(1)
        self.upper[open_] = up(np.sqrt(own.astype(np.float64)))
        still = self.upper[open_] >= tail[open_, 0]
        open_, own = open_[still], own[still]
        # Centroids before the first place whose tail certifies must be measured.
        sure = self.upper[open_, None] < tail[open_]
        need = np.where(sure.any(1), sure.argmax(1), b + 1).astype(np.int32)
        self.depth[open_] = need
        for n in np.unique(need):
            at = open_[need == n]
            if n > b:
                self.rank(at, distances(x[at], c), np.broadcast_to(np.arange(len(c), dtype=np.int32), (len(at), len(c))))
                continue
            ids = np.column_stack([self.cluster[at], self.near[at, :n]])
            found = ((x[at][:, None, :] - c[ids]) ** 2).sum(2)
            self.rank(at, found, ids)

    def listing(self, b: int) -> Bounds:
        """With the first ``b`` listed centroids; the others join the remainder."""
        rest = np.minimum(self.rest, self.lower[:, b:].min(1, initial=np.inf))
        out = Bounds(self.cluster, self.upper, self.near[:, :b], self.lower[:, :b], rest)
        out.depth = self.depth
        return out


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, max(width, 1), dtype=np.int32)[: n + 1] if width else np.zeros(n + 1, np.int32)), pa.array(values.ravel(), kind))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _round(c: np.ndarray, shift: np.ndarray | None, b: int):
    """One pass: rows of vectors with their bounds, then the task's sums."""
    arrow = pa.schema(
        [("vec_id", pa.int64()), ("vector", pa.list_(pa.int32())), ("cluster", pa.int32()), ("distance", pa.int64()), ("upper", pa.float32()), ("near", pa.list_(pa.int32())), ("lower", pa.list_(pa.float32())), ("rest", pa.float32()), ("depth", pa.int32())]
        + [("total_cluster", pa.int32()), ("total_component", pa.int32()), ("total", pa.int64()), ("total_rows", pa.int64())]
    )

    def run(batches):
        sums, counts = np.zeros(c.shape, np.int64), np.zeros(len(c), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), np.int64)
            if shift is None:
                state = Bounds.unknown(len(x), b)
            else:
                near, lower = _matrix(batch.column(4), np.int32), _matrix(batch.column(5), np.float32)
                state = Bounds(batch.column(2).to_numpy().copy(), batch.column(3).to_numpy().copy(), near, lower, batch.column(6).to_numpy().copy())
                state.move(shift)
            state.assign(x, c)
            state = state.listing(min(b, state.near.shape[1]))
            np.add.at(sums, state.cluster, x)
            counts += np.bincount(state.cluster, minlength=len(c))
            own = ((x - c[state.cluster]) ** 2).sum(1)
            none = [pa.nulls(len(x), f.type) for f in list(arrow)[9:]]
            columns = [batch.column(0), batch.column(1).cast(pa.list_(pa.int32())), pa.array(state.cluster), pa.array(own), pa.array(state.upper), _lists(state.near, pa.int32()), _lists(state.lower, pa.float32()), pa.array(state.rest), pa.array(state.depth)]
            yield pa.RecordBatch.from_arrays([*columns, *none], schema=arrow)
        at, component = (g.ravel() for g in np.meshgrid(np.flatnonzero(counts), np.arange(c.shape[1]), indexing="ij"))
        if len(at):
            none = [pa.nulls(len(at), f.type) for f in list(arrow)[:9]]
            made = [pa.array(at, pa.int32()), pa.array(component, pa.int32()), pa.array(sums[at, component]), pa.array(counts[at])]
            yield pa.RecordBatch.from_arrays([*none, *made], schema=arrow)

    return run


def _next_centroids(state: DataFrame, c: np.ndarray) -> tuple[np.ndarray, int]:
    """Centroids as rounded-down means, and the deepest place looked at."""
    rows = state.where(F.col("total_cluster").isNotNull()).groupBy("total_cluster", "total_component")
    big = lambda name: F.sum(F.col(name).cast("decimal(38,0)"))
    out = c.copy()
    for at, component, total, n in rows.agg(big("total"), big("total_rows")).collect():  # clusters x components
        out[at, component] = int(total) // int(n)
    return out, state.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]


def cluster(rows: DataFrame, k: int, rounds: int, size: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), one row a vector, and the centroids), after
    ``rounds`` rounds of assignment and means and a last assignment."""
    spark = rows.sparkSession
    vectors = integer_vectors(rows, size)
    c = first_centroids(vectors, k, seed)
    if not len(c):
        # Vectors without any vec_id start no centroid.
        return vectors.where(F.lit(False)).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), c
    b, shift, before = max(1, -(-len(c) // 4)), None, None
    state = vectors
    for n in range(rounds + 1):
        path = fresh_path(spark, "drake-state")
        columns = ["vec_id", "vector"] + (["cluster", "upper", "near", "lower", "rest"] if shift is not None else [])
        held = state if shift is None else state.where(F.col("total_cluster").isNull())
        held.select(*columns).mapInArrow(_round(c, shift, b), _STATE).write.parquet(path)
        delete_at_end(spark, path)
        state = spark.read.schema(_STATE).parquet(path)
        if before is not None:
            delete_now(spark, before)
        before = path
        if n < rounds:
            moved, depth = _next_centroids(state, c)
            shift = np.sqrt(((moved - c) ** 2).sum(1).astype(np.float64))
            c = moved
            if n:  # the first round looks at everything
                b = min(b, max(1, -(-len(c) // 8), int(depth) + 1))
    return state.where(F.col("total_cluster").isNull()).select("vec_id", "cluster", "distance"), c


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(found: DataFrame, c: np.ndarray) -> DataFrame:
    """``found`` with its cluster's inertia, the whole one, and the digest of
    its centroid."""
    sums = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}  # a row a cluster
    whole = sum(sums.values())
    named = [(int(n), int(s), int(whole), centroid_digest(c[n])) for n, s in sorted(sums.items())]
    small = found.sparkSession.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(small), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    """Per vector: its cluster, distance, inertias, digest of the centroid."""
    return with_inertia(*cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, size=64, seed=2))


def _op12_sql(rounds: int = 5, k: int = 40) -> str:
    start = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), l AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS dim, unnest(vec) AS x FROM v
), s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster FROM v
), c0 AS MATERIALIZED (SELECT s.cluster, l.dim, l.x AS y FROM s JOIN l USING (vec_id) WHERE s.cluster < {k})"""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""d{n} AS (
  SELECT vec_id, cluster, sum((x - y) * (x - y))::BIGINT AS distance FROM l JOIN c{n} USING (dim) GROUP BY vec_id, cluster
), a{n} AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS rn FROM d{n}) WHERE rn = 1
)""")
        if n < rounds:
            steps.append(f"""m{n} AS (
  SELECT a.cluster, l.dim, sum(l.x)::BIGINT AS t, count(*) AS n FROM a{n} a JOIN l USING (vec_id) GROUP BY a.cluster, l.dim
), c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, c.dim, CASE WHEN m.n IS NULL THEN c.y ELSE ((m.t - ((m.t % m.n) + m.n) % m.n) // m.n)::BIGINT END AS y
  FROM c{n} c LEFT JOIN m{n} m USING (cluster, dim)
)""")
    end = f"""
SELECT vec_id, a.cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN (SELECT cluster, sha256(string_agg(y::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) h ON a.cluster = h.cluster
"""
    return reduce(lambda x, y: f"{x}, {y}", steps, start) + end


OP12_SQL = _op12_sql()
