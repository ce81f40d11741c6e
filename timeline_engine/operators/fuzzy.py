"""Votes of noisy readings for known names, by gestalt similarity.

The similarity of two texts is 2 * M / (a + b), M the characters in the longest
common block and, on either side of it, in the longest common blocks again.
Each distinct text meets the names of fitting length only (an equi-join on the
length), M is bounded by the characters both hold, and only pairs whose bound
reaches the threshold are aligned.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def similarity(text: str, name: str, least: float = 0.0) -> float:
    """The gestalt similarity; 0 where it can't reach ``least``."""
    both = len(text) + len(name)
    if not both or 2 * sum((Counter(text) & Counter(name)).values()) < least * both:
        return 0.0
    return SequenceMatcher(None, text, name, autojunk=False).ratio()


def similar_names(texts: DataFrame, names: DataFrame, least: float) -> DataFrame:
    """(text, name, ratio) of the pairs of ``texts`` (text) and ``names`` (name)
    whose similarity is at least ``least`` (above 0)."""
    # 2 * min(a, b) / (a + b) bounds the similarity, so lengths lie close.
    short, long = least / (2 - least), (2 - least) / least
    size = F.char_length("text")
    fits = F.sequence(F.ceil(size * F.lit(short)).cast("int"), F.floor(size * F.lit(long)).cast("int"))
    t = texts.select("text").where(size > 0).distinct().withColumn("size", F.explode(fits))
    n = names.select("name").where(F.col("name").isNotNull()).distinct().withColumn("size", F.char_length("name"))

    def align(batches):
        for batch in batches:
            ratio = [similarity(x, y, least) for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ratio, pa.float64())], names=["text", "name", "ratio"])

    met = t.join(n, "size").select("text", "name").mapInArrow(align, "text string, name string, ratio double")
    return met.where(F.col("ratio") >= least - math.ulp(least))


def fuzzy_votes(readings: DataFrame, names: DataFrame, keys: Sequence[str], identity: Sequence[str], least: float = 0.7) -> DataFrame:
    """(keys, name, score) for ``readings`` (keys, identity, text, confidence):
    a reading, one ``identity``, gives each similar name the best of ratio *
    (0.5 + confidence) over its texts; a key adds up its readings.

    Readings of a key with the same texts and confidences vote alike: they are
    counted before they meet the names. The join is sorted, not hashed: the size
    of a packed table says little about its rows, so neither side is sent whole.
    """
    item = F.struct("text", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    each = readings.where(F.col("text").isNotNull()).groupBy(*keys, *identity).agg(F.array_sort(F.collect_set(item)).alias("_texts"))
    alike = each.groupBy(*keys, "_texts").agg(F.count(F.lit(1)).alias("_n"))
    asked = alike.withColumn("_item", F.explode("_texts")).withColumn("text", F.col("_item.text"))
    near = asked.join(similar_names(readings, names, least).hint("merge"), "text")
    worth = F.max(F.col("ratio") * (F.lit(0.5) + F.col("_item.confidence"))).alias("_worth")
    best = near.groupBy(*keys, "_texts", "_n", "name").agg(worth)
    return best.groupBy(*keys, "name").agg(F.sum(F.col("_n") * F.col("_worth")).alias("score"))
