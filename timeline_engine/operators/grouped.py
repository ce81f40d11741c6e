"""Python folds over sorted groups, streamed.

A grouped pandas call costs milliseconds per group, too much for many small
groups. Here rows are partitioned by the group columns and sorted inside their
partitions, and one streaming call per partition walks the groups as they come.
``stream_groups`` keeps one state per group, so a group of any length takes
constant memory; ``fold_groups`` hands over the rows of a whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

BATCH_ROWS = 20_000


def stream_groups(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], start: Callable[[tuple], object], step: Callable[[object, tuple], Iterable[tuple]], finish: Callable[[object], Iterable[tuple]], schema: str
) -> DataFrame:
    """Walks the sorted rows of each group: ``start`` makes a group's state from
    its first row (all columns of ``df``, in order), ``step`` takes each row, the
    first too, and ``finish`` ends the group. The last two give output rows of
    ``schema``."""
    names = list(df.columns)
    at = [names.index(g) for g in groups]
    made = _parse_datatype_string(schema)
    assert isinstance(made, StructType)
    arrow = to_arrow_schema(made)

    def run(batches):
        key, state, out = None, None, []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True):
                now = tuple(row[k] for k in at)
                if state is None or now != key:
                    if state is not None:
                        out += finish(state)
                    key, state = now, start(row)
                out += step(state, row)
                if len(out) >= BATCH_ROWS:
                    yield batch()
                    out = []
        if state is not None:
            out += finish(state)
        if out:
            yield batch()

    return df.repartition(*groups).sortWithinPartitions(*groups, *order).mapInArrow(run, schema)


def fold_groups(df: DataFrame, groups: Sequence[str], order: Sequence[str], fold: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """``fold`` turns the sorted rows of a group (all columns of ``df``, in
    order) into output rows of ``schema``."""

    def keep(rows: list[tuple], row: tuple) -> tuple:
        rows.append(row)
        return ()

    return stream_groups(df, groups, order, lambda _row: [], keep, fold, schema)
