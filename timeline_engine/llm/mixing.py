"""Mixing sources to target weights by Efraimidis-Spirakis sampling
(DataFrame functions only).

Every document gets a uniform number from a digest of its id and the
exponential key -ln(u) / w, w its quality weight. A source's budget is first
spent on complete epochs over all its documents; what remains is filled by the
documents of smallest key, up to where the running sum of sizes meets the
remainder. The one document that straddles the end is replaced by the unchosen
document whose size fits the gap best, so that whole documents come within a
few words of the target.

Scale: texts are read once, into a narrow table (source, size, key, number of
the row). That table is range-partitioned by source, key and, for ties, by
doc_id, size, text hash and row number; the running sum is a sum over a
source's ranges (a small table) plus a sum inside the range. Ranges follow the
rows and no two rows are equal, so neither a source with a third of all rows,
nor a doc_id (or none) that many rows share, nor a source whose documents all
have the least weight ends in one task. Tables of sources and ranges are
written before they are joined, so the planner broadcasts them only by their
measured size.

Nulls: a null text has size 0; null is a source of its own, last in order; a
null doc_id is sampled like any other. Repeated rows are separate documents.
A source of size 0 has target 0. Ties of keys fall to doc_id, then size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, table, written

#: Documents of a range: at least so many where there are few, at most about so many.
FEW_ROWS, MANY_ROWS = 4096, 500_000
#: The order of a source's documents; the row's number parts equal ones.
ORDER = ("key", "doc_id", "size", "text_hash", "row")
#: No document is taken more than this many times.
MAX_EPOCHS = 3


def quality_weight(text: Column) -> Column:
    """A weight from 0.1 to 1: falls with the share of markup symbols."""
    n = F.char_length(text)
    symbols = n - F.char_length(F.translate(text, "#*$%&|<>!", ""))
    return F.coalesce(F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(5.0) * symbols / F.greatest(n, F.lit(1))), F.lit(0.1))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, src_no, source_size, source_docs, target): one row a source.

    Sources by code point, null last, weigh ``weights`` in turn and share the
    total size; a target stops at ``MAX_EPOCHS`` times its source and the
    excess is shared again. That fixed point is min(cap, level * weight) with
    one level for all, found by prefix sums over the sources in order of
    cap / weight.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("src_no", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("src_no") - 1, F.lit(len(weights))) + 1)
    per = per.withColumn("w", weight).withColumn("cap", F.lit(float(MAX_EPOCHS)) * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), "src_no").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    per = (
        per.withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), zero))
        .withColumn("full", F.col("left") * F.col("w") >= F.col("cap") * F.col("w_left"))
    )
    level = (F.max("total").over(everything) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(zero)).over(everything)) / F.nullif(
        F.sum(F.when(F.col("full"), zero).otherwise(F.col("w"))).over(everything), zero
    )
    target = F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("w"))
    return per.select("source", "src_no", "source_size", "source_docs", target.alias("target"))


def range_count(sized: DataFrame) -> int:
    """How many ranges the rows are cut into: the shuffle setting, with fewer for
    few rows and more for many."""
    rows = sized.count()
    usual = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, -(-rows // FEW_ROWS)), -(-rows // MANY_ROWS))


def ranges(named: DataFrame, n: int) -> DataFrame:
    """``named`` with ``part``, the number of its range in the order of sources
    and documents; written, so that every later step sees the same ranges."""
    return written(named.repartitionByRange(n, "src_no", *ORDER).withColumn("part", F.spark_partition_id()), "mix-ranges")


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, copies, taken),
    one row a document; ``copies`` is how often the mix takes it."""
    text = F.col("text")
    sized = docs.select(
        "doc_id",
        "source",
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
        word_count(text).alias("size"),
        (-F.ln(uniform(F.col("doc_id"), seed)) / quality_weight(text)).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    sized = written(sized, "mix-sizes")
    sources = written(source_targets(sized, weights), "mix-sources")
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    plan = sources.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    named = sized.alias("d").join(plan.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).drop(F.col("s.source"))
    cut = ranges(named, range_count(sized))
    sums = written(cut.groupBy("src_no", "part").agg(F.sum("size").alias("part_size")), "mix-sums")
    earlier = Window.partitionBy("src_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("src_no", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("src_no", "part").orderBy(*ORDER)
    ordered = (
        cut.join(starts, ["src_no", "part"])
        .withColumn("rn", F.row_number().over(inside))
        .withColumn("upto", F.col("start") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .select("doc_id", "text_hash", "source", "size", "source_size", "target", "epochs", "rest", "src_no", "part", "rn", "upto")
    )
    ordered = written(ordered, "mix-order")
    # Without a remainder nothing more is taken, empty documents neither.
    chosen = (F.col("rest") > 0) & (F.col("upto") <= F.col("rest"))
    spent = ordered.where(chosen).groupBy("src_no").agg(F.max("upto").alias("spent"))
    gap = written(
        sources.select("src_no").join(spent, "src_no", "left").select("src_no", F.coalesce("spent", F.lit(0)).alias("spent")), "mix-spent"
    )
    rest = ordered.where(~chosen).join(gap, "src_no")
    off = F.abs(F.col("rest") - F.col("spent") - F.col("size"))
    fit = rest.where(off < F.col("rest") - F.col("spent")).groupBy("src_no").agg(F.min(F.struct(off.alias("off"), "part", "rn")).alias("fit"))
    fit = written(fit.select("src_no", F.col("fit.part").alias("fit_part"), F.col("fit.rn").alias("fit_rn")), "mix-fit")
    done = ordered.join(fit, "src_no", "left")
    also = chosen | F.coalesce((F.col("part") == F.col("fit_part")) & (F.col("rn") == F.col("fit_rn")), F.lit(False))
    copies = (F.col("epochs") + F.when(also, F.lit(1)).otherwise(F.lit(0))).cast("long")
    return done.select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, the words taken."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / coalesce(greatest(0.1, 1.0 - 5.0 * (length(text) - length(translate(text, '#*$%&|<>!', ''))) / greatest(length(text), 1)), 0.1) AS key
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS src_no
  FROM sized GROUP BY source
), w AS (
  SELECT *, ((src_no - 1) % 3 + 1)::DOUBLE AS w, 3.0 * source_size AS cap, sum(source_size::DOUBLE) OVER () AS total FROM per
), p AS (
  SELECT *, total - coalesce(sum(cap) OVER o, 0) AS room, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_room
  FROM w WINDOW o AS (ORDER BY cap / w, src_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), q AS (SELECT *, room * w >= cap * w_room AS is_full FROM p
), t AS (
  SELECT source, src_no, source_size,
         CASE WHEN is_full THEN cap ELSE (total - coalesce(sum(cap) FILTER (WHERE is_full) OVER (), 0))
              / (sum(w) FILTER (WHERE NOT is_full) OVER ()) * w END AS target
  FROM q
), e AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM t
), o AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.src_no, e.target - e.epochs * e.source_size AS rest,
         row_number() OVER k AS rn, sum(d.size) OVER k AS upto
  FROM sized d JOIN e ON d.source IS NOT DISTINCT FROM e.source
  WINDOW k AS (PARTITION BY e.src_no ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), s AS (SELECT src_no, coalesce(max(upto) FILTER (WHERE upto <= rest), 0) AS spent FROM o GROUP BY src_no
), f AS (
  SELECT src_no, min(struct_pack(gap := abs(rest - spent - size), rn := rn)) AS fit
  FROM o JOIN s USING (src_no) WHERE upto > rest AND abs(rest - spent - size) < rest - spent GROUP BY src_no
)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN upto <= rest OR coalesce(rn = f.fit.rn, false) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM o LEFT JOIN f USING (src_no)
"""
