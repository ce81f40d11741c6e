"""Runs of equal readings: gaps and islands, stitching, sessions, smoothing.

All take key columns: work is partitioned by them, and a run never crosses a
key. ``islands`` costs one shuffle on the keys, which the aggregation above it
reuses. Where one key may hold a large share of all rows, ``parts`` cuts the
table into so many ranges instead (``segmented``), with a carry between them.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import segmented
from .grouped import fold_groups


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Sequence[str], max_gap: float | None = None, time: str | None = None, name: str = "run", parts: int | None = None) -> DataFrame:
    """Adds the number of the run a row belongs to, from 1 for each key.

    A run ends where any value differs from the row before (null equals null),
    or where ``time`` jumps by more than ``max_gap``.
    """
    if parts is not None:
        columns = [*value, *([time] if max_gap is not None and time not in value else [])]
        row = F.struct(*[F.col(c) for c in columns]) if columns else F.struct(F.lit(0).alias("none"))

        def differs(x: Column, before: Column) -> Column:
            out = F.lit(False)
            for v in value:
                out = out | ~x[v].eqNullSafe(before[v])
            return out | F.coalesce(x[time] - before[time] > max_gap, F.lit(False)) if max_gap is not None else out

        return segmented.islands(df, keys, order, row, differs, parts, name)
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.lag(F.lit(1)).over(w).isNull()
    broken = first
    for v in value:
        broken = broken | ~F.col(v).eqNullSafe(F.lag(v).over(w))
    if max_gap is not None:
        broken = broken | F.coalesce(F.col(time) - F.lag(time).over(w) > max_gap, F.lit(False))
    return df.withColumn("_broken", broken.cast("int")).withColumn(name, F.sum("_broken").over(w)).drop("_broken")


def pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], time: str, gap: float, name: str, parts: int | None = None) -> DataFrame:
    """Adds the number, from 0, of the stretch of a key in which no two
    neighbours lie further apart than ``gap``."""
    return islands(df, keys, order, [], gap, time, name, parts).withColumn(name, F.col(name) - 1)


def run_lengths(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Sequence[str], time: str, max_gap: float | None = None, parts: int | None = None) -> DataFrame:
    """One row per run: keys, run, values, start_t, end_t (the last sample),
    samples.

    Where rows are ordered by ``time`` first, all of it is read off the first
    rows of runs and the last row of each key, along one sort. Otherwise runs
    are numbered and grouped."""
    if parts is None and order[0] == time:
        return _read_off(df, keys, order, value, time, max_gap)
    numbered = islands(df, keys, order, value, max_gap, time, parts=parts)
    return numbered.groupBy(*keys, "run").agg(*[F.first(v).alias(v) for v in value], F.min(time).alias("start_t"), F.max(time).alias("end_t"), F.count(F.lit(1)).alias("samples"))


def _read_off(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Sequence[str], time: str, max_gap: float | None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    t, before = F.col(time), F.lag(time).over(w)
    broken = F.lag(F.lit(1)).over(w).isNull()
    for v in value:
        broken = broken | ~F.col(v).eqNullSafe(F.lag(v).over(w))
    if max_gap is not None:
        broken = broken | F.coalesce(t - before > max_gap, F.lit(False))
    # Times never fall; missing ones come first, so the least so far is the first.
    # The order columns keep their names, so that the rows stay sorted.
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = df.select(*dict.fromkeys([*keys, *value, *order])).withColumns({"_broken": broken, "_last": F.lead(F.lit(1)).over(w).isNull(), "_before": before, "_least": F.min(time).over(so_far), "_n": F.row_number().over(w).cast("bigint")})
    kept = seen.where(F.col("_broken") | F.col("_last"))
    nxt = {f"_next{c}": F.lead(F.col(c)).over(w) for c in ("_broken", "_before", "_n", "_least")} | {"_next_t": F.lead(time).over(w)}
    kept = kept.withColumns({**nxt, "run": F.sum(F.col("_broken").cast("int")).over(w)}).where("_broken")
    ended = F.when(F.col("_last"), t).when(F.col("_next_broken"), F.col("_next_before")).otherwise(F.col("_next_t"))
    until = F.when(F.col("_last"), F.col("_n") + 1).when(F.col("_next_broken"), F.col("_next_n")).otherwise(F.col("_next_n") + 1)
    began = F.coalesce(t, F.when(ended.isNotNull(), F.col("_next_least")))
    return kept.select(*keys, "run", *value, began.alias("start_t"), ended.alias("end_t"), (until - F.col("_n")).alias("samples"))


def stitch(runs: DataFrame, keys: Sequence[str], value: Sequence[str], max_gap: float = 0.2) -> DataFrame:
    """Joins runs of one value that touch, as chunked scans leave them."""
    w = Window.partitionBy(*keys).orderBy("start_t")
    broken = F.lag(F.lit(1)).over(w).isNull() | (F.col("start_t") - F.lag("end_t").over(w) > max_gap)
    for v in value:
        broken = broken | ~F.col(v).eqNullSafe(F.lag(v).over(w))
    numbered = runs.withColumn("_broken", broken.cast("int")).withColumn("_run", F.sum("_broken").over(w))
    return numbered.groupBy(*keys, "_run").agg(*[F.first(v).alias(v) for v in value], F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.sum("samples").alias("samples")).drop("_run")


def sessions(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: float) -> DataFrame:
    """Groups of items of which each starts at most ``gap`` after the latest end
    so far: keys, session, start_t, end_t, items."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    broken = (reach.isNull() | (F.col(start) > reach + gap)).cast("int")
    numbered = df.withColumn("_broken", broken).withColumn("session", F.sum("_broken").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "session").agg(F.min(start).alias("start_t"), F.max(end).alias("end_t"), F.count(F.lit(1)).alias("items"))


def sample_interval(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Median positive step between samples of a key; 1 if there is none."""
    w = Window.partitionBy(*keys).orderBy(time)
    step = df.select(*keys, (F.col(time) - F.lag(time).over(w)).alias("_step"))
    return step.groupBy(*keys).agg(F.coalesce(F.median(F.when(F.col("_step") > 0, F.col("_step"))), F.lit(1.0)).alias("interval"))


def length_histogram(runs: DataFrame, value: str, cap: int = 10) -> DataFrame:
    """Runs by value and number of samples (the last class is open)."""
    return runs.groupBy(value, F.least("samples", F.lit(cap)).alias("length")).agg(F.count(F.lit(1)).alias("n"), F.max("samples").alias("longest"))


def bridge(runs: DataFrame, keys: Sequence[str], value: str, state: str, window: float, interval: Column | float = 0.0) -> DataFrame:
    """Relabels short runs between two runs of ``state`` and joins them.

    For one state a single pass suffices: relabelling never makes a new run
    that stands between two of the state.
    """
    w = Window.partitionBy(*keys).orderBy("start_t")
    short = F.col("end_t") - F.col("start_t") + interval <= window
    held = (F.lag(value).over(w) == state) & (F.lead(value).over(w) == state) & (F.col(value) != state) & short
    relabelled = runs.withColumn(value, F.when(held, F.lit(state)).otherwise(F.col(value)))
    return merge_equal(relabelled, keys, value)


def merge_equal(runs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Joins neighbouring runs of one value."""
    numbered = islands(runs, keys, ["start_t"], [value], name="_run")
    return numbered.groupBy(*keys, "_run").agg(F.first(value).alias(value), F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.sum("samples").alias("samples")).drop("_run")


#: Least length of a state in seconds (a state not listed has none).
LEAST_DWELL = {"live": 3.0, "replay": 0.0, "boxscore": 4.0, "series": 8.0, "other": 3.0}
#: Gap inside a state that is filled, in seconds.
BRIDGED = {"replay": 4.0}


def absorb_short(states: list, starts: list, ends: list, samples: list, interval: float, dwell: dict) -> list[tuple]:
    """Folds the shortest run below its dwell into its longer neighbour (the
    earlier of equals) until none is left; (state, start, end, samples).

    Runs are a linked list, the short ones a heap by length and place: n runs
    take n log n steps. A run that was merged keeps the place of its first."""
    n = len(states)
    states, starts, ends, samples = list(states), list(starts), list(ends), list(samples)
    before, after, alive = [*range(-1, n - 1)], [*range(1, n + 1)], [True] * n
    left = n

    def length(k: int) -> float:
        return ends[k] - starts[k]

    def entry(k: int):
        long = length(k) + interval
        return (long, k) if long < dwell.get(states[k], 0.0) else None

    short = [x for x in map(entry, range(n)) if x]
    heapq.heapify(short)
    while left > 1 and short:
        long, i = heapq.heappop(short)
        if not alive[i] or entry(i) != (long, i):
            continue  # merged since
        lo, hi = before[i], after[i]
        state = states[hi if lo < 0 or (hi < n and length(hi) > length(lo)) else lo]
        # The run and its equal neighbours on both sides become one.
        a = lo if lo >= 0 and states[lo] == state else i
        b = hi if hi < n and states[hi] == state else i
        for k in {a, i, b} - {a}:
            samples[a] += samples[k]
            alive[k] = False
            left -= 1
        states[a], ends[a], after[a] = state, ends[b], after[b]
        if after[a] < n:
            before[after[a]] = a
        if x := entry(a):
            heapq.heappush(short, x)
    return [(states[k], starts[k], ends[k], samples[k]) for k in range(n) if alive[k]]


def smooth(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, time: str, dwell: dict | None = None, bridged: dict | None = None) -> DataFrame:
    """Segments of a noisy state series: (keys, state, start_t, end_t, samples),
    with ``end_t`` one interval after the last sample, so segments tile time.

    Runs are formed and bridged by windows; only compressed runs of a key reach
    Python, where the dwell rule, whose steps depend on each other, is applied.
    """
    dwell, bridged = LEAST_DWELL if dwell is None else dwell, BRIDGED if bridged is None else bridged
    runs = run_lengths(df, keys, order, [value], time)
    steps = sample_interval(df, keys, time)
    runs = runs.join(steps, list(keys))
    for state, window in bridged.items():
        if window > 0:
            w = Window.partitionBy(*keys).orderBy("start_t")
            short = F.col("end_t") - F.col("start_t") + F.col("interval") <= window
            held = (F.lag(value).over(w) == state) & (F.lead(value).over(w) == state) & (F.col(value) != state) & short
            runs = runs.withColumn(value, F.when(held, F.lit(state)).otherwise(F.col(value)))
            numbered = islands(runs.drop("run"), keys, ["start_t"], [value])
            runs = numbered.groupBy(*keys, "run").agg(F.first(value).alias(value), F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.sum("samples").alias("samples"), F.first("interval").alias("interval"))

    n = len(keys)

    def fold(rows: list[tuple]) -> list[tuple]:
        step = float(rows[0][n + 4])
        found = absorb_short(*([r[n + k] for r in rows] for k in range(4)), step, dwell)
        return [(*rows[0][:n], state, start, end + step, samples) for state, start, end, samples in found]

    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"`{value}` {types[value]}", "start_t double", "end_t double", "samples bigint"])
    return fold_groups(runs.select(*keys, value, "start_t", "end_t", "samples", "interval"), keys, ["start_t"], fold, schema)


def gate(segments: DataFrame, state: str, least: float | None = 2.0, trim: float = 1.0) -> DataFrame:
    """Spans of a state, longer than ``least``, without ``trim`` at both ends."""
    out = segments.where(F.col("state") == state)
    if least is not None:
        out = out.where(F.col("end_t") - F.col("start_t") > least)
    return out.withColumn("start_t", F.col("start_t") + trim).withColumn("end_t", F.col("end_t") - trim)
