"""Grouped operators: weighted modes, quorums, majorities, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import half_even


def weighted_mode(df: DataFrame, keys: Sequence[str], value: str, weight: Column | None = None, seen: Column | None = None) -> DataFrame:
    """(keys, value, weight): the value of largest summed weight per key; of
    equal ones the one seen first. Null values do not take part.

    Two combined aggregations and no window: the second keeps one struct a key.
    """
    weight = F.lit(1) if weight is None else weight
    seen = F.lit(0) if seen is None else seen
    votes = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("_w"), F.min(seen).alias("_seen"))
    best = votes.groupBy(*keys).agg(F.min(F.struct((-F.col("_w")).alias("w"), F.col("_seen"), F.col(value).alias("v"))).alias("_b"))
    return best.select(*keys, F.col("_b.v").alias(value), (-F.col("_b.w")).alias("weight"))


def quorum(df: DataFrame, time: str, keys: Sequence[str], least: int) -> DataFrame:
    """(instant, members): rounded instants at which at least ``least`` distinct keys
    report."""
    hits = df.select(half_even(F.col(time)).alias("instant"), *keys).distinct()
    return hits.groupBy("instant").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= least)


def last_reading(df: DataFrame, keys: Sequence[str], time: str, payload: Sequence[str], tie: str | None = None) -> DataFrame:
    """The latest row's payload per key."""
    order = F.struct(time, *([tie] if tie else []), *[c for c in payload if c not in (time, tie)])
    best = df.groupBy(*keys).agg(F.max(order).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in payload])


def reconcile(counts: DataFrame, expected: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, found, expected, error, excess), over the keys of either side."""
    a = counts.select(*keys, F.col(value).alias("found"))
    b = expected.select(*keys, F.col(value).alias("expected"))
    both = a.join(b, list(keys), "full").fillna(0, ["found", "expected"])
    delta = F.col("found") - F.col("expected")
    return both.select(*keys, "found", "expected", F.abs(delta).alias("error"), F.greatest(delta, F.lit(0)).alias("excess"))


def precision_recall(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(class, tp, fp, fn, precision, recall) for every class in either column;
    a missing prediction is a miss only."""
    both = df.select(F.explode(F.array_distinct(F.array_compact(F.array(truth, predicted)))).alias("class"), truth, predicted)
    t, p = F.coalesce(F.col(truth) == F.col("class"), F.lit(False)), F.coalesce(F.col(predicted) == F.col("class"), F.lit(False))
    out = both.groupBy("class").agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"))
    share = lambda other: F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col(other)).cast("double"))
    return out.withColumn("precision", share("fp")).withColumn("recall", share("fn"))


def confusion(df: DataFrame, truth: str, predicted: str, k: int = 8) -> DataFrame:
    """The k most frequent wrong pairs."""
    wrong = df.where(F.col(truth) != F.col(predicted)).groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    return wrong.orderBy(F.desc("n"), truth, predicted).limit(k)


def equal_groups(df: DataFrame, value: str, identity: str, least: int = 2) -> DataFrame:
    """Groups of rows with one value: (first, members), by a digest, so the
    values themselves are not shuffled."""
    keyed = df.where(F.col(value).isNotNull()).select(F.sha2(F.col(value).cast("binary"), 256).alias("_h"), identity)
    out = keyed.groupBy("_h").agg(F.min(identity).alias("first"), F.count(F.lit(1)).alias("members"))
    return out.where(F.col("members") >= least).select("first", "members")


def majority_bits(bits: DataFrame, keys: Sequence[str], position: str, bit: str) -> DataFrame:
    """(keys, position, bit): 1 where more than half of the votes are."""
    votes = bits.groupBy(*keys, position).agg(F.sum(bit).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return votes.select(*keys, position, (F.col("_s") * 2 > F.col("_n")).cast("int").alias("bit"))


def agreement(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, compared, equal) of two columns as text; nulls are not compared."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return df.where(both).groupBy(*keys).agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col(a).cast("string") == F.col(b).cast("string")).alias("equal"))


def occupancy(segments: DataFrame, state: str, top: int = 3) -> DataFrame:
    """(state, total, share, longest): time per state, its share of all time,
    and the lengths of its ``top`` longest segments, which are ranked before
    they are gathered."""
    lengths = segments.select(state, (F.col("end_t") - F.col("start_t")).alias("_l"))
    total = lengths.groupBy(state).agg(F.sum("_l").alias("total"))
    rank = F.row_number().over(Window.partitionBy(state).orderBy(F.desc("_l")))
    most = lengths.withColumn("_r", rank).where(F.col("_r") <= top).groupBy(state).agg(F.sort_array(F.collect_list("_l"), asc=False).alias("longest"))
    share = F.col("total") / F.sum("total").over(Window.partitionBy())
    return total.withColumn("share", share).join(most, state)


def consistent_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, consistent): one value per key, and whether it is the only
    one."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value), (F.min(value).eqNullSafe(F.max(value))).alias("consistent"))
