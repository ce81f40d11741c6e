"""Runs of a panel's fields, while it is live and drawn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grouped import stream_groups
from .storage import settled


def panel_runs(readings: DataFrame, keys: Sequence[str], order: Sequence[str], time: str, fields: Sequence[str], live: str, drawn: str) -> tuple[DataFrame, DataFrame]:
    """Readings of a panel, one row a sample -> (runs, counts).

    Runs are (keys, field, value, start_t, end_t, samples), of each field on its
    own: equal values in a row, with null a value. A sample that isn't live, or
    without the panel, ends the runs of all fields. Counts are (keys, what, n):
    samples that are ``live``, those ``drawn`` among them, and per field those
    drawn but ``unread <field>`` (null).

    One pass: a key's samples are streamed in order and one open run a field is
    held. Values are compared as text.
    """
    n = len(keys)
    names = [*keys, *[c for c in order if c not in keys], *([] if time in order else [time]), "_live", "_drawn", "_values"]
    i_time = names.index(time)
    rows = readings.withColumns({"_live": F.coalesce(F.col(live), F.lit(False)), "_drawn": F.coalesce(F.col(drawn), F.lit(False)), "_values": F.array(*[F.col(f).cast("string") for f in fields])})

    class State:
        def __init__(self, row: tuple):
            self.key, self.open = row[:n], {}
            self.counts = {"live": 0, "drawn": 0, **{f"unread {f}": 0 for f in fields}}

        def close(self) -> list[tuple]:
            out = [(*self.key, "run", f, *run) for f, run in self.open.items()]
            self.open = {}
            return out

    def step(state: State, row: tuple) -> list[tuple]:
        is_live, is_drawn, values = row[-3:]
        state.counts["live"] += is_live
        if not is_live or not is_drawn:
            return state.close()
        state.counts["drawn"] += 1
        t, out = row[i_time], []
        for f, value in zip(fields, values, strict=True):
            state.counts[f"unread {f}"] += value is None
            run = state.open.get(f)
            if run is not None and run[0] == value:
                run[2], run[3] = t, run[3] + 1
                continue
            if run is not None:
                out.append((*state.key, "run", f, *run))
            state.open[f] = [value, t, t, 1]
        return out

    def finish(state: State) -> list[tuple]:
        return state.close() + [(*state.key, "count", what, None, None, None, k) for what, k in state.counts.items()]

    types = dict(readings.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "kind string, field string, value string, start_t double, end_t double, samples bigint"])
    both = settled(stream_groups(rows.select(*names), keys, order, State, step, finish, schema))
    runs = both.where(F.col("kind") == "run").drop("kind")
    return runs, both.where(F.col("kind") == "count").select(*keys, F.col("field").alias("what"), F.col("samples").alias("n"))
