"""Names for clusters, from series that are on screen at the same time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def values_at(left: DataFrame, series: Mapping[str, DataFrame], keys: Sequence[str], t: str) -> DataFrame:
    """Each left row with the value, at ``t``, of every series: runs (keys,
    start_t, end_t, value), of which those of one key and series don't overlap.
    Null where no run covers the instant (ends included).

    All as-of joins share one shuffle and one sort: left rows and the runs of
    all series are one union, along which the latest run of each is carried.
    """
    row = F.struct(*[F.col(c) for c in left.columns])
    both = left.select(*keys, F.col(t).alias("_t"), F.lit(1).alias("_side"), row.alias("_row"))
    for name, runs in series.items():
        run = F.struct("end_t", F.col("value").alias("value")).alias(f"_{name}")
        both = both.unionByName(runs.select(*keys, F.col("start_t").alias("_t"), F.lit(0).alias("_side"), run), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = both.withColumns({f"_{name}": F.last(f"_{name}", ignorenulls=True).over(w) for name in series}).where(F.col("_row").isNotNull())
    value = lambda name: F.when(F.col(f"_{name}.end_t") >= F.col("_t"), F.col(f"_{name}.value")).alias(name)
    return held.select(*[F.col(f"_row.{c}").alias(c) for c in left.columns], *[value(name) for name in series])


def cluster_names(votes: DataFrame, cluster: str, name: str, distance: str, seen: Sequence[str], alike: float = 0.02, least: int = 20) -> DataFrame:
    """(cluster, label, winner, led, pairings): the name most often paired
    with each cluster (of equals the one ``seen`` first), joined by others that
    look the same: at least ``least`` pairings whose median distance is within
    ``alike`` of the winner's, of a name that leads no cluster.

    Votes are combined per (cluster, name); what follows is one row for each.
    """
    each = votes.groupBy(cluster, name).agg(F.count(F.lit(1)).alias("_n"), F.median(distance).alias("_median"), F.min(F.struct(*seen)).alias("_seen"))
    order = Window.partitionBy(cluster).orderBy(F.desc("_n"), "_seen", name)
    whole = Window.partitionBy(cluster)
    ranked = each.withColumn("_k", F.row_number().over(order)).withColumn("_best", F.max(F.when(F.col("_k") == 1, F.col("_median"))).over(whole))
    leaders = ranked.where(F.col("_k") == 1).select(F.col(name).alias("_leader")).distinct()
    ranked = ranked.join(leaders, F.col(name) == F.col("_leader"), "left")
    same = (F.abs(F.col("_median") - F.col("_best")) <= alike) & (F.col("_n") >= least) & F.col("_leader").isNull()
    held = F.array_sort(F.collect_list(F.when((F.col("_k") == 1) | same, F.col(name))))
    first = lambda c: F.max(F.when(F.col("_k") == 1, F.col(c)))
    out = ranked.groupBy(cluster).agg(held.alias("_held"), first(name).alias("winner"), first("_n").alias("led"), F.sum("_n").alias("pairings"))
    return out.select(cluster, F.array_join("_held", " / ").alias("label"), "winner", "led", "pairings")
