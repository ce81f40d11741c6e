"""Connected components of a link table, by alternating star contraction.

Links of a batch are first contracted to stars inside their task. Each step
then maps every neighbour to the smallest id around a node, with a map-side
combined minimum and a join; no neighbour list is ever gathered. Rows of a node
with many links take its minimum from a broadcast list (at most 2 * ``PARTS``
such nodes); the join deals them to all tasks, not to one. The link table is
written out after each round, and rounds end when every node is either a
centre or has one link to a centre (a logarithmic number of them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Links that are contracted together inside a task.
LOCAL_LINKS = 500_000
#: A node is a hub if it holds more than this and one PARTS-th of all links.
LEAST_HUB, PARTS = 256, 4_096
_LINK = "u bigint, v bigint"


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node it reaches) for the nodes that reach a lesser one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    least = np.arange(len(nodes))
    while True:
        p, q = least[x], least[y]
        if np.array_equal(p, q):
            break
        low = np.minimum(p, q)
        np.minimum.at(least, p, low)
        np.minimum.at(least, q, low)
        while not np.array_equal(least, least[least]):
            least = least[least]
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[moved], nodes[least[moved]]


def _contracted(batches):
    held, size = [], 0

    def out():
        u, v = stars(*(np.concatenate(c) for c in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
        if size >= LOCAL_LINKS:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _state(links: DataFrame) -> tuple[int, int]:
    """(number of links, number of nodes that keep them from being stars: with
    two links to lesser nodes, or links to both lesser and greater ones)."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(links.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    wrong = ((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).cast("int")
    row = nodes.agg(F.coalesce(F.sum("down"), F.lit(0)), F.coalesce(F.sum(wrong), F.lit(0))).first()
    return int(row[0]), int(row[1])


def _star(links: DataFrame, large: bool, hub: int) -> DataFrame:
    both = links.union(links.select(F.col("v"), F.col("u"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
    hubs = F.broadcast(least.where(F.col("n") > hub).select(F.col("u").alias("hub"), F.col("m").alias("of_hub")))
    # A hub's rows know their minimum and go anywhere.
    tagged = both.join(hubs, F.col("u") == F.col("hub"), "left")
    tagged = tagged.withColumn("key", F.when(F.col("hub").isNull(), F.col("u")).otherwise(F.xxhash64("u", "v")))
    joined = tagged.join(least.select(F.col("u").alias("key"), "m"), "key", "left").withColumn("m", F.coalesce("of_hub", "m"))
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return out.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of ``links`` (a, b), the smallest node
    it reaches. Self links and nulls are ignored."""
    links = links.where(F.col("a") != F.col("b")).select(F.col("a").cast("bigint").alias("u"), F.col("b").cast("bigint").alias("v"))
    links = written(links.mapInArrow(_contracted, _LINK).distinct(), "links")
    n, wrong = _state(links)
    while wrong:
        hub = max(LEAST_HUB, n // PARTS)
        links = written(_star(_star(links, True, hub), False, hub), "links")
        n, wrong = _state(links)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select(F.col("v"), F.col("v")).distinct())


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found``, a result of ``components``, after further ``links`` (a, b):
    only links between its components are contracted anew."""
    a, b = (found.select(F.col("node").alias(k), F.col("component").alias(f"{k}_c")) for k in "ab")
    lifted = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("a_c", "a").alias("a"), F.coalesce("b_c", "b").alias("b"))
    above = components(lifted).withColumnsRenamed({"node": "top", "component": "reached"})
    moved = found.join(above, F.col("component") == F.col("top"), "left").select("node", F.coalesce("reached", "component").alias("component"))
    new = above.join(found.select("node"), F.col("top") == F.col("node"), "left_anti").select("top", "reached")
    return written(moved.union(new), "components")
