"""Runs and sessions of an unbounded stream.

Both take event time with a watermark. Runs keep one open run per key in the
state store and close it when the value changes, or when the watermark passes
its last sample by ``gap``. Rows of one micro-batch are ordered before they are
folded; rows older than the watermark are dropped by Spark, as late data, so
results equal the batch operators on input that arrives in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RUN = "value string, start_t double, end_t double, samples bigint"


def stream_runs(events: DataFrame, key: str, value: str, ts: str, gap: float, delay: str = "10 minutes") -> DataFrame:
    """Closed runs (key, value, start_t, end_t, samples) of a stream, appended
    as they close. ``ts`` is a zone-less or zoned timestamp column."""
    kind = dict(events.dtypes)[key]
    rows = events.select(F.col(key), F.col(value).cast("string").alias("value"), F.col(ts).cast("timestamp").alias("_ts")).withWatermark("_ts", delay)

    def fold(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_ = list(state.get) if state.exists else None
        done = []
        if state.hasTimedOut:
            done.append(open_)
            state.remove()
            open_ = None
        else:
            seen = pd.concat(list(batches)).sort_values("_ts", kind="stable")
            times = seen["_ts"].astype("datetime64[us]").astype("int64").to_numpy() / 1e6
            for v, t in zip(seen["value"].where(seen["value"].notna(), None), times.tolist(), strict=True):
                if open_ is not None and open_[0] == v and t - open_[2] <= gap:
                    open_ = [v, open_[1], t, open_[3] + 1]
                else:
                    if open_ is not None:
                        done.append(open_)
                    open_ = [v, t, t, 1]
            state.update(tuple(open_))
            state.setTimeoutTimestamp(max(int((open_[2] + gap) * 1000) + 1, state.getCurrentWatermarkMs() + 1))
        out = pd.DataFrame(done, columns=["value", "start_t", "end_t", "samples"])
        out.insert(0, key, keys[0])
        yield out

    return rows.groupBy(key).applyInPandasWithState(fold, f"`{key}` {kind}, {RUN}", RUN, "append", GroupStateTimeout.EventTimeTimeout)


def stream_sessions(events: DataFrame, key: str, ts: str, gap: str, delay: str = "10 minutes") -> DataFrame:
    """Sessions (key, start, end, items): events at most ``gap`` apart."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    out = rows.groupBy(key, F.session_window("_ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("items"), F.max("_ts").alias("end"))
    return out.select(key, F.col("w.start").alias("start"), "end", "items")


def stream_counts(events: DataFrame, keys: list[str], ts: str, window: str, slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Events per key and time window (tumbling, or sliding by ``slide``)."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    w = F.window("_ts", window, slide) if slide else F.window("_ts", window)
    out = rows.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("items"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "items")
