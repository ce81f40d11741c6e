"""Parameter grids: chaining at every setting in one pass, scored against counts.

A key's sightings are shuffled and sorted once. One fold streams them and
carries, for every setting of features, gap and slack, the chains that are still
open; a chain that can't grow any more is counted for each least number of
frames and forgotten. Memory holds the open chains of the settings, whatever the
length of a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .grouped import stream_groups


class _Setting:
    """The open chains of one setting: [last t, last slot, features, frames]."""

    def __init__(self, places: Sequence[int], gap: float, slack: float, least: Sequence[int]):
        self.places, self.gap, self.slack = places, gap, slack
        self.least, self.counts = least, [0] * len(least)
        self.open: list[list] = []
        self.waiting: list[list] = []

    def _count(self, chain: list) -> None:
        for k, frames in enumerate(self.least):
            self.counts[k] += chain[3] >= frames

    def instant(self, t: float) -> None:
        """A new instant: chains last seen too long ago end, the others wait."""
        held = []
        for chain in self.open:
            if t - chain[0] <= self.gap:
                held.append(chain)
            else:
                self._count(chain)
        self.open, self.waiting = held, sorted(held, key=lambda c: c[1])

    def see(self, t: float, slot: int, row: tuple) -> None:
        features = [row[k] for k in self.places]
        for k, chain in enumerate(self.waiting):
            if chain[1] >= slot and all(abs(x - y) <= self.slack for x, y in zip(chain[2], features, strict=True)):
                chain[:] = [t, slot, features, chain[3] + 1]
                del self.waiting[k]
                return
        self.open.append([t, slot, features, 1])

    def finish(self) -> list[int]:
        for chain in self.open:
            self._count(chain)
        return self.counts


def chain_grid(
    df: DataFrame, keys: Sequence[str], time: str, slot: str, features: Mapping[str, Sequence[str]], gaps: Sequence[float], slacks: Sequence[float], least_frames: Sequence[int], tie: Sequence[str] = ()
) -> DataFrame:
    """(keys, features, max_gap, slack, min_frames, events): the chains of each
    key at each setting, by the rule of ``sequences.chains``."""
    names = [*keys, time, slot, *dict.fromkeys(c for f in features.values() for c in f), *tie]
    names = list(dict.fromkeys(names))
    n, i_time, i_slot = len(keys), names.index(time), names.index(slot)
    grid = [(f, g, s) for f, g, s in product(features, gaps, slacks)]

    class State:
        def __init__(self, row: tuple):
            self.key, self.t = row[:n], None
            self.settings = [_Setting([names.index(c) for c in features[f]], g, s, least_frames) for f, g, s in grid]

    def step(state, row: tuple) -> tuple:
        t = row[i_time]
        for setting in state.settings:
            if t != state.t:
                setting.instant(t)
            setting.see(t, row[i_slot], row)
        state.t = t
        return ()

    def finish(state) -> list[tuple]:
        out = []
        for (f, g, s), setting in zip(grid, state.settings, strict=True):
            out += [(*state.key, f, float(g), float(s), frames, count) for frames, count in zip(least_frames, setting.finish(), strict=True)]
        return out

    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "features string", "max_gap double", "slack double", "min_frames int", "events bigint"])
    return stream_groups(df.select(*names), keys, [time, slot, *tie], State, step, finish, schema)


def grid_scores(counts: DataFrame, expected: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(features, max_gap, slack, min_frames, events, error, excess, best) of the
    ``counts`` of a grid against the ``expected`` number per key: the summed
    difference, what exceeds, and whether no setting has less of both, in turn."""
    setting = ["features", "max_gap", "slack", "min_frames"]
    # Every key counts at every setting: expected keys without a chain as well.
    settings = counts.select(*setting).distinct()
    wanted = expected.select(*keys, F.col(value).alias("_want")).join(F.broadcast(settings))  # the grid is a fixed list
    both = counts.join(wanted, [*keys, *setting], "full")
    more = F.coalesce("events", F.lit(0)) - F.coalesce("_want", F.lit(0))
    out = both.groupBy(*setting).agg(F.sum(F.coalesce("events", F.lit(0))).alias("events"), F.sum(F.abs(more)).alias("error"), F.sum(F.greatest(more, F.lit(0))).alias("excess"))
    first = F.row_number().over(Window.orderBy("error", "excess", *setting)) == 1  # one row a setting
    return out.withColumn("best", first)
