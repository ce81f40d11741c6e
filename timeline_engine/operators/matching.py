"""One-to-one matching of events in time, nearest pairs first.

Candidates come from a binned interval join on the key; the greedy choice runs
per key and per connected stretch of time: where two neighbouring instants of a
key lie further apart than the window, no candidate crosses, so a busy key is
cut into independent pieces and no piece holds more than such a stretch.
Numbering the pieces takes a window over the key; with ``parts`` the table is
cut into ranges for it and a busy key needs no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grouped import fold_groups
from .runs import pieces


def greedy_pairs(a: list[float], b: list[float], window: float, offset: float = 0.0, signed: bool = False) -> list[tuple[int, int]]:
    """Index pairs with |b - (a + offset)| <= window, each index used once,
    taken by distance, then (``signed``) earlier before later, then position in
    ``a``, then in ``b``; both sorted."""
    found, lo = [], 0
    for i, t in enumerate(a):
        centre = t + offset
        while lo < len(b) and b[lo] < centre - window:
            lo += 1
        j = lo
        while j < len(b) and b[j] <= centre + window:
            far = b[j] - centre
            found.append((abs(far), far if signed else 0.0, i, j))
            j += 1
    found.sort()
    used_a, used_b, out = set(), set(), []
    for _, _, i, j in found:
        if i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            out.append((i, j))
    return out


def match_events(falls: DataFrame, events: DataFrame, keys: Sequence[str], window: float, offset: float = 0.0, parts: int | None = None) -> DataFrame:
    """(keys, t, matched_t, delta): every fall with the event it is matched to,
    or nulls. Events of one key and instant count once."""
    shifted = falls.select(*keys, (F.col("t") + offset).alias("_at"), F.col("t"), F.lit(0).alias("_side"))
    named = events.select(*keys, F.col("t").alias("_at"), F.col("t"), F.lit(1).alias("_side")).distinct()
    both = pieces(shifted.unionByName(named), keys, ["_at"], "_at", window, "_piece", parts)

    n = len(keys)

    def choose(rows: list[tuple]) -> list[tuple]:
        mine = sorted(r[n] for r in rows if r[n + 1] == 0)
        theirs = sorted(r[n] for r in rows if r[n + 1] == 1)
        hit = dict(greedy_pairs(mine, theirs, window, offset))
        matched = [theirs[hit[i]] if i in hit else None for i in range(len(mine))]
        return [(*rows[0][:n], t, m, None if m is None else m - (t + offset)) for t, m in zip(mine, matched, strict=True)]

    types = dict(falls.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "t double", "matched_t double", "delta double"])
    return fold_groups(both.select(*keys, "t", "_side", "_piece"), [*keys, "_piece"], ["t"], choose, schema)


def match_both(steps: DataFrame, events: DataFrame, keys: Sequence[str], window: float, parts: int | None = None) -> DataFrame:
    """(keys, t, event_t, delta) of every step of a counter and every event,
    matched one-to-one, nearest first; a step without event, or an event without
    step, has null on the other side. Each row counts, equal ones too."""
    both = steps.select(*keys, "t", F.lit(0).alias("_side")).unionByName(events.select(*keys, "t", F.lit(1).alias("_side")))
    both = pieces(both, keys, ["t"], "t", window, "_piece", parts)
    n = len(keys)

    def choose(rows: list[tuple]) -> list[tuple]:
        mine, theirs = ([r[n] for r in rows if r[n + 1] == side] for side in (0, 1))
        hit = dict(greedy_pairs(mine, theirs, window, signed=True))
        left = sorted(set(range(len(theirs))) - set(hit.values()))
        pairs = [(t, theirs[hit[i]] if i in hit else None) for i, t in enumerate(mine)] + [(None, theirs[j]) for j in left]
        return [(*rows[0][:n], t, e, None if t is None or e is None else e - t) for t, e in pairs]

    types = dict(steps.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "t double", "event_t double", "delta double"])
    return fold_groups(both.select(*keys, "t", "_side", "_piece"), [*keys, "_piece"], ["t", "_side"], choose, schema)


def candidate_counts(falls: DataFrame, events: DataFrame, keys: Sequence[str], offsets: Sequence[float], window: float) -> DataFrame:
    """For each offset, how many falls have an event in the window, and how many
    candidate pairs there are. Falls are repeated per offset, a fixed list."""
    shift = falls.withColumn("offset", F.explode(F.array(*[F.lit(float(x)) for x in offsets]))).withColumn("_c", F.col("t") + F.col("offset"))
    shift = shift.withColumn("_id", F.struct(*keys, "t"))
    spans = shift.select(*keys, "offset", "_id", (F.col("_c") - window).alias("_lo"), (F.col("_c") + window).alias("_hi"))
    from .temporal_joins import interval_join

    met = interval_join(events.select(*keys, F.col("t").alias("event_t")), spans, keys, "event_t", "_lo", "_hi", width=2 * window)
    count = met.groupBy("offset").agg(F.count_distinct("_id").alias("falls_with_candidate"), F.count(F.lit(1)).alias("candidates"))
    base = shift.groupBy("offset").agg(F.count(F.lit(1)).alias("falls"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return base.join(count, "offset", "left").select("offset", "falls", zero("falls_with_candidate"), zero("candidates"))


def sweep(falls: DataFrame, events: DataFrame, keys: Sequence[str], offsets: Sequence[float], window: float, parts: int | None = None) -> DataFrame:
    """(offset, falls, matched) of the one-to-one matching at each offset.

    Rows are shuffled once: pieces are cut where no offset lets a fall meet an
    event, and the fold of a piece tries all offsets, a fixed list."""
    tried = [float(x) for x in offsets]
    reach = max(max(abs(x - window), abs(x + window)) for x in tried) * (1 + 1e-9) + 1e-9  # beyond rounding
    both = falls.select(*keys, "t", F.lit(0).alias("_side")).unionByName(events.select(*keys, "t").distinct().withColumn("_side", F.lit(1)))
    both = pieces(both, keys, ["t"], "t", reach, "_piece", parts)
    n = len(keys)

    def try_all(rows: list[tuple]) -> list[tuple]:
        mine, theirs = ([r[n] for r in rows if r[n + 1] == side] for side in (0, 1))
        if not mine:
            return []
        return [(x, len(mine), len(greedy_pairs(mine, theirs, window, x)) if theirs else 0) for x in tried]

    found = fold_groups(both.select(*keys, "t", "_side", "_piece"), [*keys, "_piece"], ["t", "_side"], try_all, "offset double, falls bigint, matched bigint")
    return found.groupBy("offset").agg(F.sum("falls").alias("falls"), F.sum("matched").alias("matched"))
