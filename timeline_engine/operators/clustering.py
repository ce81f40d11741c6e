"""Greedy clustering of small bitmaps: calibration-sized inputs, grouped by key;
neighbour counts of packed bitmaps, in blocks.

Exact duplicates are merged by an aggregation before anything is compared, so a
group holds distinct bitmaps only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bitmaps import normalised_distance, unpack
from .grouped import fold_groups

#: Distinct bitmaps of a key in one block, and of one step inside a task.
BLOCK, TILE = 32_768, 4_096


def medoids(distance: np.ndarray, threshold: float, recount: bool = False) -> list[list[int]]:
    """Clusters of members within ``threshold`` of a seed. Seeds by number of
    neighbours (first of equals): counted once, or with ``recount`` anew among
    what is left, then strictly below the threshold. Largest cluster first."""
    close = distance < threshold if recount else distance <= threshold
    left = np.ones(len(distance), bool)
    found = []
    order = np.argsort(-close.sum(1), kind="stable")
    while left.any():
        if recount:
            seed = int(np.argmax(np.where(left, (close & left).sum(1), -1)))
        else:
            seed = int(next(i for i in order if left[i]))
        members = np.flatnonzero(left & (close[seed] | (np.arange(len(distance)) == seed)))
        left[members] = False
        found.append([seed, *(int(m) for m in members if m != seed)])
    return sorted(found, key=len, reverse=True)


def leaders(masks: Sequence[np.ndarray], radius: float) -> list[int]:
    """The cluster of each mask in order: the first leader within ``radius``,
    else a new one."""
    heads: list[np.ndarray] = []
    out = []
    for m in masks:
        k = next((i for i, h in enumerate(heads) if normalised_distance(h, m) <= radius), len(heads))
        if k == len(heads):
            heads.append(m)
        out.append(k)
    return out


def cluster_bitmaps(df: DataFrame, keys: Sequence[str], threshold: float, method: str = "medoid") -> DataFrame:
    """(keys, h, w, b, n, cluster) of the distinct bitmaps of each key."""
    distinct = df.groupBy(*keys, "h", "w", "b").agg(F.count(F.lit(1)).alias("n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "h", "w", "b"], ascending=[False, True, True, True]).reset_index(drop=True)
        masks = [unpack(h, w, b) for h, w, b in zip(pdf["h"], pdf["w"], pdf["b"], strict=True)]
        if method == "leader":
            pdf["cluster"] = leaders(masks, threshold)
        else:
            d = np.array([[normalised_distance(a, b) for b in masks] for a in masks])
            for number, members in enumerate(medoids(d, threshold, recount=method == "recount")):
                pdf.loc[members, "cluster"] = number
        pdf["cluster"] = pdf["cluster"].astype("int64")
        return pdf

    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"h {types['h']}", f"w {types['w']}", f"b {types['b']}", "n bigint", "cluster bigint"])
    return distinct.groupBy(*keys).applyInPandas(run, schema)


def within(x: np.ndarray, y: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """For each bitmap of ``x`` the weights of those of ``y`` within ``most`` bits
    of it (uint64 bitmaps). Ones are counted as bits; what a weight has beyond
    one is added for the few bitmaps that have it."""
    out = np.zeros(len(x), np.int64)
    heavy = weights != 1
    for lo in range(0, len(y), TILE):
        tile = y[lo : lo + TILE]
        for k in range(0, len(x), 32):
            close = np.bitwise_count(x[k : k + 32, None] ^ tile) <= most
            out[k : k + 32] += np.bitwise_count(np.packbits(close, axis=1)).sum(1, dtype=np.int64)
    if heavy.any():
        tile, more = y[heavy], weights[heavy] - 1
        for k in range(0, len(x), 32):
            for lo in range(0, len(tile), TILE):
                close = np.bitwise_count(x[k : k + 32, None] ^ tile[lo : lo + TILE]) <= most
                out[k : k + 32] += (close * more[lo : lo + TILE]).sum(1)
    return out


def near_counts(bitmaps: DataFrame, key: str, most: int, block: int = BLOCK) -> DataFrame:
    """(key, bits, near): for each of the distinct ``bitmaps`` (key, bits BIGINT,
    n) the n of its key's bitmaps within ``most`` bits, its own n included.

    A radius of a third of the bits leaves no index that meets few pairs, so all
    pairs of a key are compared, but none becomes a row. A key's bitmaps are
    dealt into blocks by hash, two blocks meet in a task, which holds no more
    than these, and one count a bitmap leaves it. A key of up to ``block``
    bitmaps is shuffled once; one of k blocks k times, at three numbers a row.
    """
    bitmaps = bitmaps.where(F.col(key).isNotNull())
    # At most one key in ``block`` rows has more than one block.
    large = bitmaps.groupBy(key).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > block)
    large = large.select(key, F.ceil(F.col("_size") / block).cast("int").alias("_blocks"))
    placed = bitmaps.join(F.broadcast(large), key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    placed = placed.withColumn("_block", F.pmod(F.xxhash64("bits"), F.col("_blocks").cast("bigint")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    cells = placed.select(key, "_block", "bits", "n", other).select(key, F.least("_block", "_other").alias("_lo"), F.greatest("_block", "_other").alias("_hi"), "_block", "bits", "n")

    def meet(rows: list[tuple]) -> list[tuple]:
        of, lo, hi = rows[0][:3]
        sides = []
        for at in sorted({lo, hi}):
            mine = [r for r in rows if r[3] == at]
            sides.append((np.array([r[4] for r in mine], np.int64).view(np.uint64), np.array([r[5] for r in mine], np.int64)))
        out = []
        for (x, _), (y, n) in [(sides[0], sides[-1]), (sides[-1], sides[0])][: len(sides)]:
            out += zip([of] * len(x), x.view(np.int64).tolist(), within(x, y, n, most).tolist(), strict=True)
        return out

    schema = f"`{key}` {dict(bitmaps.dtypes)[key]}, bits bigint, near bigint"
    met = fold_groups(cells, [key, "_lo", "_hi"], [], meet, schema)
    return met.groupBy(key, "bits").agg(F.sum("near").alias("near"))
