"""Changes, folds and chains along ordered rows."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grouped import fold_groups, stream_groups
from .runs import pieces
from .segmented import ranges


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], skip_null: str | None = None) -> DataFrame:
    """Adds prev_<column>; rows whose ``skip_null`` is null are left out first,
    so they do not part their neighbours."""
    if skip_null is not None:
        df = df.where(F.col(skip_null).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns})


def with_next(df: DataFrame, order: str, columns: Sequence[str], per_block: int = 200_000, most_blocks: int = 20_000) -> DataFrame:
    """Adds next_<column> of the next row of the whole table by ``order``; null
    for rows without it. A table of more than ``per_block`` rows is cut into
    ranges of about as many rows, however ``order`` is distributed; the first row
    of each range (at most ``most_blocks`` rows in one task) is handed to the
    range before."""
    n = df.agg(F.count(order)).first()[0]
    blocks = max(1, min(most_blocks, n // per_block))
    known = df.where(F.col(order).isNotNull())
    none = df.where(F.col(order).isNull()).withColumns({f"next_{c}": F.lit(None).cast(dict(df.dtypes)[c]) for c in columns})
    if blocks == 1:
        w = Window.orderBy(order)
        return known.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns}).unionByName(none)
    placed = ranges(known, [], [order], blocks)
    item = F.struct(order, *[F.col(c) for c in columns if c != order])
    heads = placed.groupBy("_part").agg(F.min_by(item, order).alias("_item"))
    before = F.lag("_part").over(Window.orderBy("_part"))
    handed = heads.withColumn("_part", before).where(F.col("_part").isNotNull()).select("_part", "_item.*", F.lit(True).alias("_handed"))
    w = Window.partitionBy("_part").orderBy(order, F.col("_handed").asc_nulls_first())
    both = placed.unionByName(handed, allowMissingColumns=True).withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return both.where(F.col("_handed").isNull()).drop("_part", "_handed").unionByName(none)


def changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], when: Column, skip_null: str | None = None) -> DataFrame:
    """Rows at which ``when``, over columns and their prev_ forms, holds."""
    return with_previous(df, keys, order, columns, skip_null).where(when)


def up_to_fall(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows before the first one that lies below the highest so far."""
    w = Window.partitionBy(*keys).orderBy(*order)
    high = F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fell = F.coalesce((F.col(value) < high).cast("int"), F.lit(0))
    marked = df.withColumn("_fell", fell)
    return marked.withColumn("_any", F.max("_fell").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where(F.col("_any") == 0).drop("_fell", "_any")


def staircase(df: DataFrame, keys: Sequence[str], order: Sequence[str], left: str, right: str, start: str = "start_t", end: str = "end_t") -> DataFrame:
    """Pairs that never fall below the last accepted pair in either part; equal
    accepted pairs in a row are one, whose end is the latest.

    A running maximum is not enough, since a rejected pair must not raise the
    bar: each pair is judged by the one accepted before it. A key's pairs are
    streamed in order and the last accepted pair is all that is held.
    """
    cols = [*keys, *[c for c in order if c not in keys], *[c for c in (left, right, start, end) if c not in order and c not in keys]]
    n, (l, r, s, e) = len(keys), (cols.index(c) for c in (left, right, start, end))
    below = lambda a, b: a is not None and b is not None and a < b

    def take(top: list, row: tuple):
        if top[0] is None:
            top[0] = [*row[:n], row[l], row[r], row[s], row[e]]
            return
        last = top[0]
        if below(row[l], last[n]) or below(row[r], last[n + 1]):
            return
        if None not in (row[l], row[r]) and row[l] == last[n] and row[r] == last[n + 1]:
            last[n + 3] = max((x for x in (last[n + 3], row[e]) if x is not None), default=None)
            return
        top[0] = [*row[:n], row[l], row[r], row[s], row[e]]
        yield tuple(last)

    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in (*keys, left, right, start, end))
    by = [*order, *[c for c in (left, right, start, end) if c not in order]]
    return stream_groups(df.select(*cols), keys, by, lambda _row: [None], take, lambda top: [tuple(top[0])], schema)


def joined_boundaries(rows: list[tuple], tolerance: float, once: bool) -> list[tuple[float, set]]:
    """Boundaries (t, names) of the instants (rank, t, name) of one stretch, in
    the order they are made. Those made are kept sorted by t, so an instant looks
    at the ones within the tolerance only."""
    made: list[tuple[float, set]] = []
    placed: list[tuple[float, int]] = []
    for _, t, name in sorted(rows):
        lo = bisect_left(placed, (t - tolerance, -1))
        best = None
        while lo < len(placed) and placed[lo][0] - t <= tolerance:
            k = placed[lo][1]
            if abs(placed[lo][0] - t) <= tolerance and not (once and name in made[k][1]) and (best is None or k < best):
                best = k
            lo += 1
        if best is None:
            insort(placed, (t, len(made)))
            made.append((t, {name}))
        else:
            made[best][1].add(name)
    return made


def consensus(witnesses: DataFrame, keys: Sequence[str], time: str, name: str, rank: str, tolerance: float, needed: int, once: bool = False, parts: int | None = None) -> DataFrame:
    """Boundaries that several witnesses saw: (keys, t, witnesses, confirmed).

    Witness lists are merged in the order of ``rank``, then time: an instant
    joins the first boundary made that lies within ``tolerance`` (with ``once``,
    and lacks this witness), else makes a new one.

    A boundary lies at an instant, so none reaches across a gap longer than the
    tolerance: each key is cut there, and memory holds one such stretch.
    """
    types = dict(witnesses.dtypes)
    seen = witnesses.select(*keys, F.col(time).cast("double").alias("_t"), F.col(rank).cast("int").alias("_rank"), F.col(name).alias("_name"))
    # Half as much again: the cut must not lie at a distance that still joins.
    cut = pieces(seen, keys, ["_t", "_rank", "_name"], "_t", 1.5 * tolerance, "_piece", parts)
    n = len(keys)

    def join(rows: list[tuple]) -> list[tuple]:
        made = joined_boundaries([(r[n + 1], r[n], r[n + 2]) for r in rows], tolerance, once)
        return [(*rows[0][:n], t, sorted(names), len(names) >= needed) for t, names in made]

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "t double", f"witnesses array<{types[name]}>", "confirmed boolean"])
    return fold_groups(cut.select(*keys, "_t", "_rank", "_name", "_piece"), [*keys, "_piece"], ["_t"], join, schema)


def every_nth(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Systematic sample: the first row of every ``n`` of a key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") % n == (1 if n > 1 else 0)).drop("_n")


def seeded_sample(df: DataFrame, keys: Sequence[str], identity: str, size: int, seed: str) -> DataFrame:
    """The ``size`` rows of each key with the least digest of seed and identity:
    the same rows at every run, whatever the order of the table. Ranks are
    limited before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.md5(F.concat(F.lit(seed), F.col(identity).cast("string")).cast("binary")), identity)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= size).drop("_n")


def chains(rows: list[tuple], max_gap: float, slack: float) -> list[list[int]]:
    """Chains of sightings: rows are (t, slot, features), sorted by t and slot.

    A row joins, of the open chains last seen before its instant, at most
    ``max_gap`` ago, in the same or a higher slot, with features within
    ``slack``, and not yet continued at this instant, the one of lowest last
    slot; else it starts a chain. Returns row numbers per chain.
    """
    out: list[list[int]] = []
    live: list[list[int]] = []
    i = 0
    while i < len(rows):
        t = rows[i][0]
        live = [c for c in live if t - rows[c[-1]][0] <= max_gap]
        # Only chains last seen before t may grow now, each once.
        waiting = sorted((c for c in live), key=lambda c: rows[c[-1]][1])
        while i < len(rows) and rows[i][0] == t:
            _, slot, features = rows[i]
            for k, chain in enumerate(waiting):
                last = rows[chain[-1]]
                if last[1] >= slot and all(abs(x - y) <= slack for x, y in zip(last[2], features, strict=True)):
                    chain.append(i)
                    del waiting[k]
                    break
            else:
                chain = [i]
                out.append(chain)
                live.append(chain)
            i += 1
    return out


def chain_events(df: DataFrame, keys: Sequence[str], time: str, slot: str, features: Sequence[str] = (), max_gap: float = 6.0, slack: float = 3.0, tie: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Adds ``chain`` (per key and session) to sightings.

    A key's time is first cut into sessions where nothing is seen for longer
    than ``max_gap``: no chain crosses such a gap, so sessions are independent
    tasks. Numbering them takes a window over the key; with ``parts`` the table
    is cut into ranges for it and a busy key needs no single task.
    """
    cut = pieces(df, keys, [time, slot, *tie], time, max_gap, "_session", parts)

    names = [*df.columns, "_session"]
    i_time, i_slot, i_shape = names.index(time), names.index(slot), [names.index(f) for f in features]

    def follow(rows: list[tuple]) -> list[tuple]:
        found = chains([(r[i_time], r[i_slot], tuple(r[k] for k in i_shape)) for r in rows], max_gap, slack)
        number = {row: c for c, members in enumerate(found) for row in members}
        return [(*r, number[i]) for i, r in enumerate(rows)]

    schema = ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), "session bigint", "chain bigint"])
    return fold_groups(cut.select(*names), [*keys, "_session"], [time, slot, *tie], follow, schema)


def chain_summary(chained: DataFrame, keys: Sequence[str], time: str, slot: str, first: Sequence[str] = (), any_of: Sequence[str] = ()) -> DataFrame:
    """One event per chain: first instant and labels, flags, frames, slots."""
    at = F.struct(time, slot)
    out = chained.groupBy(*keys, "session", "chain").agg(
        F.min(time).alias("t"),
        *[F.min_by(c, at).alias(c) for c in first],
        *[F.bool_or(c).alias(c) for c in any_of],
        F.count(F.lit(1)).alias("frames"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col(slot).alias("s")))), lambda x: x["s"]).alias("slots"),
    )
    return out


def infer_preset(df: DataFrame, time: str) -> DataFrame:
    """(min_step, preset): 'sparse' if samples lie more than 0.5 s apart or are
    fewer than three, else 'dense'. Every step between instants that follow each
    other counts, whatever its length."""
    distinct = df.select(F.col(time).alias("t")).where(F.col("t").isNotNull()).distinct()
    steps = with_next(distinct, "t", ["t"]).select((F.col("next_t") - F.col("t")).alias("step"))
    both = steps.agg(F.min("step").alias("min_step"), F.count(F.lit(1)).alias("n"))
    sparse = (F.coalesce("n", F.lit(0)) < 3) | F.coalesce(F.col("min_step") > 0.5, F.lit(True))
    return both.select("min_step", F.when(sparse, "sparse").otherwise("dense").alias("preset"))
