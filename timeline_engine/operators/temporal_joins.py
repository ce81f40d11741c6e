"""As-of and interval joins.

As-of joins are windows over the union of both sides: one shuffle on the keys
and a sort, no pairing of rows. Where one key may hold a large share of all
rows, ``parts`` cuts the union into so many ranges, with a carry between them. Interval joins cut time into bins about as long as an interval,
which turns the range condition into an equi-join that is then refined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import segmented


def _sided(left: DataFrame, right: DataFrame, keys: Sequence[str], t_left: str, t_right: str, payload: Sequence[str], right_first: bool) -> tuple[DataFrame, DataFrame]:
    row = F.struct(*[F.col(c) for c in left.columns])
    item = F.struct(*[F.col(c) for c in payload])
    a = left.select(*keys, F.col(t_left).alias("_t"), F.lit(1 if right_first else 0).alias("_side"), row.alias("_row"))
    b = right.select(*keys, F.col(t_right).alias("_t"), F.lit(0 if right_first else 1).alias("_side"), item.alias("_item"))
    return a, b


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], t_left: str, t_right: str, payload: Sequence[str], forward: bool = False, strict: bool = False, tie: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Each left row with ``payload`` of the latest right row at or before it
    (``forward``: the earliest at or after it; ``strict``: not at it). Right
    rows of one instant are ordered by ``tie``: backward takes the last of them,
    forward the first. Left rows without a match keep nulls."""
    # At one instant, an allowed right row must be met before the left row. Both
    # directions look back along their own order, with a running frame.
    a, b = _sided(left, right, keys, t_left, t_right, payload, right_first=not strict)
    both = a.unionByName(b, allowMissingColumns=True)
    ties = [F.col(f"_item.{c}") for c in tie]
    if forward:
        order = [F.col("_t").desc(), F.col("_side").asc(), *[c.desc() for c in ties]]
    else:
        order = [F.col("_t").asc(), F.col("_side").asc(), *[c.asc() for c in ties]]
    if parts is not None:
        out = segmented.last_found(both, keys, order, "_item", parts, "_found")
    else:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = both.withColumn("_found", F.last("_item", ignorenulls=True).over(w))
    out = out.where(F.col("_row").isNotNull())
    return out.select(*[F.col(f"_row.{c}") for c in left.columns], *[F.col(f"_found.{c}") for c in payload])


def value_at(left: DataFrame, runs: DataFrame, keys: Sequence[str], t: str, payload: Sequence[str], closed: bool = True) -> DataFrame:
    """Each left row with ``payload`` of the run that covers it, else nulls.
    Runs of a key must not overlap, so the covering run is the latest begun."""
    held = asof(left, runs.select(*keys, "start_t", "end_t", *payload), keys, t, "start_t", ["end_t", *payload])
    inside = F.col(t) <= F.col("end_t") if closed else F.col(t) < F.col("end_t")
    return held.select(*left.columns, *[F.when(inside, F.col(c)).alias(c) for c in payload])


def _binned(df: DataFrame, lo, hi, width: float) -> DataFrame:
    return df.withColumn("_bin", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width))))


def interval_join(points: DataFrame, spans: DataFrame, keys: Sequence[str], t: str, start: str = "start_t", end: str = "end_t", how: str = "inner", closed: bool = True, width: float = 60.0) -> DataFrame:
    """Points with the spans that cover them. Spans are repeated per bin of
    ``width`` they touch, which should be about their length."""
    p = points.withColumn("_bin", F.floor(F.col(t) / width)).alias("p")
    s = _binned(spans, F.col(start), F.col(end), width).alias("s")
    on = [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys] + [F.col("p._bin") == F.col("s._bin"), F.col(f"p.{t}") >= F.col(f"s.{start}")]
    on.append(F.col(f"p.{t}") <= F.col(f"s.{end}") if closed else F.col(f"p.{t}") < F.col(f"s.{end}"))
    joined = p.join(s, on, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_bin")
    return joined.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"s.{c}") for c in spans.columns if c not in keys])


def covered(points: DataFrame, spans: DataFrame, keys: Sequence[str], t: str, start: str = "start_t", end: str = "end_t") -> DataFrame:
    """Points whose instant lies in a span of their key (ends included), whatever
    the spans' lengths and overlaps: the latest end of the spans begun so far is
    a running maximum. One shuffle on the keys; no span is repeated."""
    a = points.select(*keys, F.col(t).alias("_t"), F.struct(*[F.col(c) for c in points.columns]).alias("_row"))
    b = spans.select(*keys, F.col(start).alias("_t"), F.col(end).alias("_until")).where(F.col("_t").isNotNull())
    so_far = Window.partitionBy(*keys).orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.where(F.col("_t").isNotNull()).unionByName(b, allowMissingColumns=True).withColumn("_until", F.max("_until").over(so_far))
    # A missing key equals none, in a join.
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return both.where(F.col("_row").isNotNull() & (F.col("_t") <= F.col("_until")) & known).select("_row.*")


def near(points: DataFrame, others: DataFrame, keys: Sequence[str], t: str, t_other: str, before: float, after: float, how: str = "left_semi") -> DataFrame:
    """Points with (``left_semi``) or without (``left_anti``) another point in
    [t - before, t + after]."""
    spans = others.select(*keys, (F.col(t_other) - after).alias("_lo"), (F.col(t_other) + before).alias("_hi"))
    return interval_join(points, spans, keys, t, "_lo", "_hi", how, width=max(before + after, 1e-9))


def first_covering(points: DataFrame, runs: DataFrame, keys: Sequence[str], identity: Sequence[str], t: str, payload: Sequence[str], slack: float = 0.25, width: float = 60.0) -> DataFrame:
    """Each point with the run begun first of those that cover it within
    ``slack``; points are told apart by ``identity``."""
    spans = runs.select(*keys, (F.col("start_t") - slack).alias("_lo"), (F.col("end_t") + slack).alias("_hi"), F.struct("start_t", *payload).alias("_run"))
    met = interval_join(points, spans, keys, t, "_lo", "_hi", width=width).groupBy(*identity).agg(F.min("_run").alias("_run"))
    return points.join(met, list(identity), "left").select(*points.columns, *[F.col(f"_run.{c}").alias(c) for c in payload])


def overlapping(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left_semi", width: float = 60.0) -> DataFrame:
    """Spans of ``a`` that share an instant with a span of ``b`` (or none)."""
    x = _binned(a, F.col("start_t"), F.col("end_t"), width).alias("x")
    y = _binned(b.select(*keys, "start_t", "end_t"), F.col("start_t"), F.col("end_t"), width).alias("y")
    on = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys] + [F.col("x._bin") == F.col("y._bin")]
    on += [F.col("x.start_t") <= F.col("y.end_t"), F.col("y.start_t") <= F.col("x.end_t")]
    hit = x.join(y, on, "left_semi").drop("_bin").distinct()
    return hit if how == "left_semi" else a.join(hit.select(*keys, "start_t", "end_t"), [*keys, "start_t", "end_t"], "left_anti")


def overlapping_others(a: DataFrame, b: DataFrame, who: str, width: float = 3600.0) -> DataFrame:
    """Spans of ``a`` that share an instant (ends included) with a span of ``b``
    of another ``who``. Null instants and a null ``who`` meet nothing.

    Time is the only key, so pairs would grow with the square of a busy hour.
    Instead: a span is met if, of the others' spans begun by its end, the latest
    end is not before its start. The two latest ends of different ``who`` answer
    that for every ``who``; they are carried along the bins of ``width`` (at most
    three rows a bin in one task) and then along the rows inside each bin.
    """
    known = F.col(who).isNotNull() & F.col("start_t").isNotNull() & F.col("end_t").isNotNull()
    place = lambda t: F.floor(F.col(t) / width).alias("_bin")
    begun = b.where(known).select(place("start_t"), F.col("start_t").alias("_t"), F.struct(F.col("end_t").alias("end"), F.col(who).alias("who")).alias("_span"))
    asked = a.where(known).select(place("end_t"), F.col("end_t").alias("_t"), F.struct(*[F.col(c) for c in a.columns]).alias("_row"))

    def with_second(df: DataFrame, w) -> DataFrame:
        """Adds _second: its running maximum is the latest span that is not of
        the ``who`` of the running maximum of _span."""
        before = F.max("_span").over(w.rowsBetween(Window.unboundedPreceding, -1))
        df = df.withColumn("_before", before)
        return df.withColumn("_second", F.when(F.col("_span.who") != F.col("_before.who"), F.least("_span", "_before"))).drop("_before")

    latest = begun.groupBy("_bin", F.col("_span.who").alias("_who")).agg(F.max("_span").alias("_span"))
    rank = F.row_number().over(Window.partitionBy("_bin").orderBy(F.col("_span").desc()))
    latest = latest.withColumn("_rank", rank).where(F.col("_rank") <= 2).select("_bin", "_span")
    bins = begun.select("_bin").union(asked.select("_bin")).distinct()
    w = Window.orderBy("_bin")
    carried = with_second(bins.unionByName(latest, allowMissingColumns=True), w)
    earlier = w.rangeBetween(Window.unboundedPreceding, -1)
    pair = F.array(F.max("_span").over(earlier), F.max("_second").over(earlier))
    carried = carried.withColumn("_pair", pair).where(F.col("_span").isNull()).select("_bin", F.explode("_pair").alias("_span")).where(F.col("_span").isNotNull())
    carried = carried.withColumn("_t", F.lit(float("-inf")))

    both = begun.unionByName(carried).unionByName(asked, allowMissingColumns=True)
    w = Window.partitionBy("_bin").orderBy(F.col("_t"), F.col("_row").isNotNull())
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = with_second(both, w).withColumns({"_span": F.max("_span").over(running), "_second": F.max("_second").over(running)}).where(F.col("_row").isNotNull())
    end = F.when(F.col("_span.who") == F.col(f"_row.{who}"), F.col("_second.end")).otherwise(F.col("_span.end"))
    return met.where(end >= F.col("_row.start_t")).select("_row.*")


def pair_series(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, spans: DataFrame | None = None) -> DataFrame:
    """Runs of the pair (left value, right value), at every start of either.

    At each start in the union of both sides the covering runs are looked up;
    starts where a side is missing, null, or outside ``spans`` are skipped, and
    equal pairs in a row become one (skipped starts do not part them). Runs of a
    side and key must not overlap; spans may.

    All of it is read along one sort: the run begun last of either side, and the
    latest end of the spans begun so far, are running maxima.
    """
    none = F.lit(None).cast("double")
    run = F.struct(F.col("start_t").alias("start"), F.col("end_t").alias("end"), F.col(value).alias("value"))
    begun = [d.select(*keys, F.col("start_t").alias("t"), run.alias(c), none.alias("_until")) for d, c in ((left, "_left"), (right, "_right"))]
    if spans is not None:
        begun.append(spans.select(*keys, F.col("start_t").alias("t"), F.col("end_t").cast("double").alias("_until")))
    seen = begun[0].unionByName(begun[1], allowMissingColumns=True)
    for more in begun[2:]:
        seen = seen.unionByName(more, allowMissingColumns=True)
    return pairs_begun(seen, keys, spans is not None)


def pairs_begun(seen: DataFrame, keys: Sequence[str], spanned: bool) -> DataFrame:
    """``pair_series`` of rows (keys, t, _left, _right, _until): each the beginning
    t of a run (start, end, value) of one side or of a span ending at _until."""
    w = Window.partitionBy(*keys).orderBy("t")
    so_far = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("_left").isNotNull() | F.col("_right").isNotNull()
    held = seen.where(F.col("t").isNotNull()).withColumns({"_l": F.max("_left").over(so_far), "_r": F.max("_right").over(so_far), "_covered": F.max("_until").over(so_far), "_own": own})
    inside = (F.col("t") <= F.col("_l.end")) & (F.col("t") <= F.col("_r.end")) & F.col("_l.value").isNotNull() & F.col("_r.value").isNotNull() & F.col("_own")
    if spanned:
        inside = inside & (F.col("t") <= F.col("_covered"))
    # Starts at one instant find the same pair, so the first stands for all.
    both = held.where(inside).select(*keys, "t", F.col("_l.value").alias("left_value"), F.col("_r.value").alias("right_value"), F.least("_l.end", "_r.end").alias("e"))
    # Ends never fall either, so a run of pairs ends with its last start.
    broken = F.lag(F.lit(1)).over(w).isNull()
    for c in ("left_value", "right_value"):
        broken = broken | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    both = both.withColumns({"_broken": broken, "_last": F.lead(F.lit(1)).over(w).isNull(), "_before": F.lag("e").over(w)}).where(F.col("_broken") | F.col("_last"))
    both = both.withColumns({"_next_broken": F.lead("_broken").over(w), "_next_before": F.lead("_before").over(w), "_next_e": F.lead("e").over(w)}).where("_broken")
    end = F.when(F.col("_last"), F.col("e")).when(F.col("_next_broken"), F.col("_next_before")).otherwise(F.col("_next_e"))
    return both.select(*keys, F.col("t").alias("start_t"), end.alias("end_t"), "left_value", "right_value")


def instants(runs: DataFrame, step: float, name: str = "t") -> DataFrame:
    """Every instant start_t + k * step inside each run."""
    k = F.sequence(F.lit(0), F.floor((F.col("end_t") - F.col("start_t")) / step).cast("int"))
    return runs.withColumn("_k", F.explode(k)).withColumn(name, F.col("start_t") + F.col("_k") * F.lit(step)).drop("_k")
