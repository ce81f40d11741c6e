"""From rows of a feed to events, and events against the counters they explain.

Rows are sightings of one entry, frame by frame (``sources.files.SIGHTINGS``
with a key, the broadcast). They are chained by their geometry before any name
is read; the bitmaps of a chain are pooled, and each entry is read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bitmaps as B
from . import sequences as S
from .grouped import fold_groups

#: Fixed value: greatest distance of a name that only one frame shows.
LONE_DISTANCE = 0.45


@dataclass(frozen=True)
class Preset:
    """How rows of one sampling rate are chained: the features that tell an
    entry, how far they may move, the longest gap, the fewest frames."""

    features: tuple[str, ...]
    slack: float
    max_gap: float
    least_frames: int


#: Fixed values of both sampling rates: widths of the three tokens once a
#: second, places of the last two twelve times a second.
PRESETS = {
    "sparse": Preset(("signature[0]", "signature[1]", "signature[2]"), 3, 6.0, 1),
    "dense": Preset(("x[1]", "x[2]"), 2, 1.25, 5),
}

Names = dict[str, Sequence[np.ndarray]]


def read_pair(attacker: np.ndarray, victim: np.ndarray, names: Names, teams: dict[str, str] | None = None, cross_team: bool = False) -> tuple:
    """((label, distance, runner-up, its distance) of both names, whether they
    are of one side)."""
    first, second = B.rank_names(attacker, names), B.rank_names(victim, names)
    a, v = B.accept_pair(first, second, teams or {}) if cross_team else (B.accept(first), B.accept(second))
    same = a[0] is not None and v[0] is not None and (teams or {}).get(a[0]) == (teams or {}).get(v[0])
    return a, v, same


def _bitmap(x) -> np.ndarray:
    return B.unpack(x["h"], x["w"], x["b"])


def read_rows(rows: DataFrame, names: Names, teams: dict[str, str] | None = None, cross_team: bool = False) -> DataFrame:
    """Each row with the names read in its own frame: attacker, victim, their
    distances, resolved (both names are known), same_team."""
    @F.pandas_udf("attacker string, attacker_distance double, victim string, victim_distance double, same_team boolean")
    def read(attacker: pd.DataFrame, victim: pd.DataFrame) -> pd.DataFrame:
        known: dict[tuple, tuple] = {}
        out = []
        for key in zip(attacker["h"], attacker["w"], attacker["b"], victim["h"], victim["w"], victim["b"], strict=True):
            if key not in known:
                a, v, same = read_pair(B.unpack(*key[:3]), B.unpack(*key[3:]), names, teams, cross_team)
                known[key] = (a[0], a[1], v[0], v[1], same)
            out.append(known[key])
        return pd.DataFrame(out, columns=["attacker", "attacker_distance", "victim", "victim_distance", "same_team"])

    got = rows.withColumn("_read", read("attacker_bmp", "victim_bmp"))
    resolved = F.col("_read.attacker").isNotNull() & F.col("_read.victim").isNotNull()
    return got.select(*rows.columns, "_read.*", resolved.alias("resolved"))


def build_events(rows: DataFrame, keys: Sequence[str], names: Names, teams: dict[str, str] | None = None, preset: str | Preset = "sparse", cross_team: bool = False, lone: float = LONE_DISTANCE) -> DataFrame:
    """(keys, t, attacker, victim, medal, frames, slots, same_team): one event a
    chain of at least the preset's frames.

    The names are read off the majority of a chain's bitmaps, so what one frame
    spoils others mend. An entry that a single frame shows must be read better
    than ``lone``, else it keeps no name. Chains are cut into sessions where
    nothing is seen (``sequences.chain_events``), so no key needs one task.
    """
    p = PRESETS[preset] if isinstance(preset, str) else preset
    shape = [f"_f{k}" for k in range(len(p.features))]
    marked = rows.select(
        *keys, "t", "slot", *[F.expr(f).cast("double").alias(n) for f, n in zip(p.features, shape, strict=True)],
        "attacker_bmp", "victim_bmp", F.col("medal_bmp").isNotNull().alias("medal"),
    )
    chained = S.chain_events(marked, keys, "t", "slot", shape, p.max_gap, p.slack)
    group = [*keys, "session", "chain"]
    chained = chained.select(*group, "t", "slot", "attacker_bmp", "victim_bmp", "medal")
    n = len(group)
    least, most = p.least_frames, lone

    def read(found: list[tuple]) -> list[tuple]:
        if len(found) < least:
            return []
        pooled = [B.majority([_bitmap(r[n + k]) for r in found]) for k in (2, 3)]
        a, v, same = read_pair(*pooled, names, teams, cross_team)
        unsure = len(found) == 1 and max(a[1], v[1]) > most
        labels = (None, None) if unsure else (a[0], v[0])
        return [(*found[0][: len(keys)], found[0][n], *labels, any(r[n + 4] for r in found), len(found), [r[n + 1] for r in found], same and not unsure)]

    types = dict(rows.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "t double, attacker string, victim string, medal boolean, frames bigint, slots array<int>, same_team boolean"])
    return fold_groups(chained, group, ["t", "slot"], read, schema)


def feed_events(rows: DataFrame, keys: Sequence[str], names: Names, teams: dict[str, str] | None = None) -> DataFrame:
    """Rows to events in one call; the preset follows from the sampling step."""
    preset = S.infer_preset(rows, "t").first()["preset"]
    return build_events(rows, keys, names, teams, preset)


def resolved(events: DataFrame) -> DataFrame:
    """Events both of whose names are known."""
    return events.where(F.col("attacker").isNotNull() & F.col("victim").isNotNull())


def neighbour_votes(rows: DataFrame, votes: DataFrame, keys: Sequence[str], reach: int = 3, weight: float = 0.5) -> DataFrame:
    """(keys, t, slot, role, label, agreement): the label that a row's own votes
    and, at ``weight``, those of its neighbours in time prefer.

    ``rows``: keys, t, slot, signature; ``votes``: keys, t, slot, role, player,
    weight. A neighbour has the same signature, lies 1 to ``reach`` whole
    seconds off, and in a slot that the entry can have come from or gone to
    (entries only rise). Equal sums fall to the first name. An equi-join on time
    and signature, each row repeated 2 * ``reach`` times.
    """
    here = rows.select(*keys, "t", "slot", F.col("signature").cast("string").alias("_sig"))
    steps = [d for d in range(-reach, reach + 1) if d]
    ask = here.withColumn("_d", F.explode(F.array(*[F.lit(float(d)) for d in steps]))).withColumn("_at", F.col("t") + F.col("_d"))
    there = here.select(*keys, F.col("t").alias("_at"), F.col("slot").alias("_slot"), "_sig")
    met = ask.join(there, [*keys, "_at", "_sig"])
    rises = F.when(F.col("_d") < 0, F.col("_slot") <= F.col("slot")).otherwise(F.col("_slot") >= F.col("slot"))
    links = met.where(rises).select(*keys, "t", "slot", "_at", "_slot", F.lit(float(weight)).alias("_w"))
    own = here.select(*keys, "t", "slot", F.col("t").alias("_at"), F.col("slot").alias("_slot"), F.lit(1.0).alias("_w"))
    cast = votes.select(*keys, F.col("t").alias("_at"), F.col("slot").alias("_slot"), "role", "player", F.col("weight").alias("_vote"))
    pooled = links.unionByName(own).join(cast, [*keys, "_at", "_slot"]).groupBy(*keys, "t", "slot", "role", "player").agg(F.sum(F.col("_w") * F.col("_vote")).alias("_sum"))
    best = F.min(F.struct((-F.col("_sum")).alias("s"), F.col("player")))
    out = pooled.groupBy(*keys, "t", "slot", "role").agg(best.alias("_b"), F.sum("_sum").alias("_all"))
    return out.select(*keys, "t", "slot", "role", F.col("_b.player").alias("label"), F.round(-F.col("_b.s") / F.col("_all"), 3).alias("agreement"))


def first_of(events: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, t, attacker, victim): the first event of each part."""
    best = events.groupBy(*part).agg(F.min(F.struct("t", "attacker", "victim")).alias("_b"))
    return best.select(*part, "_b.*")


def victims_of_side(events: DataFrame, part: Sequence[str], sides: DataFrame) -> DataFrame:
    """(part, side, victims): the victims of each side, in order of time;
    ``sides``: the first of ``part``, name, side."""
    known = events.where(F.col("victim").isNotNull()).join(sides.withColumnRenamed("name", "victim"), [part[0], "victim"])
    held = known.groupBy(*part, "side").agg(F.array_sort(F.collect_list(F.struct("t", "victim"))).alias("_v"))
    return held.select(*part, "side", F.transform("_v", lambda v: v["victim"]).alias("victims"))


# Calibration


def majority_templates(df: DataFrame, keys: Sequence[str], by: str = "width", least: int = 3) -> DataFrame:
    """(keys, variant, n, h, w, b): one majority bitmap for each label (the last
    of ``keys``) and width, or whole shape, that at least ``least`` observations
    have; ``variant`` numbers a label's by their frequency. Input: keys, h, w, b."""
    shape = ["w"] if by == "width" else ["h", "w"]
    n = len(keys)
    names = [*keys, "h", "w", "b"]

    def pool(rows: list[tuple]) -> list[tuple]:
        if len(rows) < least:
            return []
        h, w, b = B.pack(B.majority([B.unpack(*r[n : n + 3]) for r in rows]))
        return [(*rows[0][:n], len(rows), h, w, b)]

    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n bigint, h int, w int, b string"])
    made = fold_groups(df.select(*names), [*keys, *shape], ["b"], pool, schema)
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), "h", "w")
    return made.withColumn("variant", F.row_number().over(order) - 1)


def single_path(successor: dict[int, int], expected: int) -> list[int] | None:
    """The one path through a successor map, if it has one start and passes all
    ``expected`` nodes."""
    starts = set(successor) - set(successor.values())
    if len(starts) != 1:
        return None
    path = [starts.pop()]
    while path[-1] in successor and len(path) <= expected:
        path.append(successor[path[-1]])
    return path if len(path) == expected == len(set(path)) else None


def digits_of_counter(series: DataFrame, keys: Sequence[str], time: str, glyph: str, expected: int = 10) -> DataFrame:
    """(keys, glyph, digit): the clusters of a counter's last glyph named by
    arithmetic alone. A counter that steps by one goes through its digits in
    order, so the glyph that most often follows each gives a path from 0 to 9;
    the wrap from the last to the first is the rarest step and is left out. Keys
    whose steps give no single path have no rows."""
    w = Window.partitionBy(*keys).orderBy(time)
    steps = series.withColumn("_next", F.lead(glyph).over(w)).where(F.col("_next") != F.col(glyph))
    counts = steps.groupBy(*keys, glyph, "_next").agg(F.count(F.lit(1)).alias("_n"))
    n = len(keys)

    def name(rows: list[tuple]) -> list[tuple]:
        best: dict[int, tuple] = {}
        for r in rows:
            a, b, times = r[n], r[n + 1], r[n + 2]
            best[a] = max(best.get(a, (0, 0)), (times, -b))
        if len(best) == expected:  # the wrap closes the circle: open it there
            del best[min(best, key=lambda a: (best[a][0], a))]
        path = single_path({a: -b for a, (_, b) in best.items()}, expected)
        return [(*rows[0][:n], g, d) for d, g in enumerate(path or ())]

    types = dict(series.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"`{glyph}` {types[glyph]}", "digit int"])
    return fold_groups(counts.select(*keys, glyph, "_next", "_n"), keys, [glyph, "_next"], name, schema)
