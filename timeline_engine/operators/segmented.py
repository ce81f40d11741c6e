"""Running results along a busy key: ranges, summaries, carry.

A window over a key sorts all its rows in one task. Where one key may hold a
large share of the table, the table is cut into ranges of (key, order) instead,
balanced by Spark's range partitioning whatever the keys: a busy key spans many
ranges, many small keys share one. A running result is computed inside each
(range, key); a summary of each key's piece (its first and last row, its last
found item, its number of breaks) is scanned along the ranges; what earlier
ranges hand over, the carry, is then applied inside the ranges.

Only keys that span several ranges need a carry: at most two rows a range, so
the scan and the broadcast of the carries are bounded by the number of ranges.
The order must be total inside a key (rows that tie in it may be numbered in any
order). The ranges are settled, so that every step sees the same ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import settled


def ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], parts: int) -> DataFrame:
    """``df`` with ``_part``, the number of its range of (keys, order)."""
    by = [F.col(c) if isinstance(c, str) else c for c in (*keys, *order)]
    return settled(df.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()))


def _inside(keys: Sequence[str], order: Sequence[Column | str]):
    return Window.partitionBy("_part", *keys).orderBy(*order)


def _along(summary: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, object]:
    """The summary rows of keys that span several ranges, and the window along
    the ranges of a key."""
    spans = Window.partitionBy(*keys).orderBy("_part")
    whole = spans.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    several = summary.withColumn("_n", F.count(F.lit(1)).over(whole)).where(F.col("_n") > 1).drop("_n")
    return several, spans


def _handed(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of its piece's carry, if there is one."""
    c = carry.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(("_part", *keys))], *[x for x in carry.columns if x not in ("_part", *keys)])
    same = F.lit(True)
    for i, k in enumerate(("_part", *keys)):
        same = same & F.col(k).eqNullSafe(F.col(f"_c{i}"))
    # At most two rows a range.
    return df.join(F.broadcast(c), same, "left").drop(*[f"_c{i}" for i in range(len(keys) + 1)])


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], row: Column, broken: Callable[[Column, Column], Column], parts: int, name: str = "run") -> DataFrame:
    """Adds the number of the run a row belongs to, from 1 for each key: a row
    starts one if it is its key's first or ``broken`` (its ``row``, that of the
    row before) holds."""
    w = _inside(keys, order)
    cut = ranges(df, keys, order, parts).withColumn("_row", row)
    local = cut.withColumns({"_first": F.lag(F.lit(1)).over(w).isNull(), "_end": F.lead(F.lit(1)).over(w).isNull(), "_before": F.lag("_row").over(w)})
    step = F.when(F.col("_first"), F.lit(0)).otherwise(broken(F.col("_row"), F.col("_before")).cast("int"))
    local = local.withColumn("_step", step).withColumn("_local", F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = local.where(F.col("_first") | F.col("_end")).groupBy("_part", *keys)
    summary = ends.agg(F.max(F.when(F.col("_first"), F.col("_row"))).alias("_head"), F.max(F.when(F.col("_end"), F.col("_row"))).alias("_tail"), F.max(F.when(F.col("_end"), F.col("_local"))).alias("_breaks"))
    several, along = _along(summary, keys)
    before = F.lag("_tail").over(along)
    first = F.lag(F.lit(1)).over(along).isNull()
    several = several.withColumn("_opens", F.when(first, F.lit(1)).otherwise(broken(F.col("_head"), before).cast("int")))
    done = F.coalesce(F.sum(F.col("_opens") + F.col("_breaks")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = settled(several.select("_part", *keys, (done + F.col("_opens")).alias("_offset")))
    out = _handed(local, carry, keys)
    return out.select(*df.columns, (F.coalesce("_offset", F.lit(1)) + F.col("_local")).cast("bigint").alias(name))


def last_found(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], item: str, parts: int, name: str) -> DataFrame:
    """Adds the last ``item`` that is not null up to each row of its key."""
    w = _inside(keys, order)
    cut = ranges(df, keys, order, parts)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({"_local": F.last(item, ignorenulls=True).over(running), "_end": F.lead(F.lit(1)).over(w).isNull()})
    several, along = _along(local.where("_end").select("_part", *keys, "_local"), keys)
    before = F.last("_local", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    carry = settled(several.select("_part", *keys, before.alias("_carry")))
    return _handed(local, carry, keys).select(*df.columns, F.coalesce("_local", "_carry").alias(name))
