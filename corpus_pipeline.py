"""A corpus pipeline of five stages: quality rules, line deduplication, near
duplicates, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and rereads it as the next stage's input.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeline_engine.llm import hilbert_pack, line_dedup, mixing, parity_join, quality_rules
from timeline_engine.llm.common import table, written


def plain(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` under names of the pipeline's own (c0, c1, ...), with those of
    doc_id and text, so that no column can clash with one made here."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("doc_id")], names[docs.columns.index("text")]


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    own, doc_id, text = plain(docs)
    rejected = quality_rules.judge(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).distinct()
    return own.join(rejected, F.col(doc_id).eqNullSafe(F.col("_id")) & (text_hash(text) == F.col("_h")), "left_anti").toDF(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are cut from the texts."""
    own, doc_id, text = plain(docs)
    named = own.withColumnsRenamed({doc_id: "doc_id", text: "text"})
    out = line_dedup.apply_bitmaps(named, line_dedup.keep_bitmaps(docs), ("_lines", "_dropped", "_kept"))
    made = {"text": F.col("_kept"), "n_chars": F.char_length("_kept").cast("bigint")}
    each = [made.get(c, F.col(n)).alias(n) for c, n in zip(docs.columns, named.columns, strict=True)]
    return out.select(*each).toDF(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the least doc_id, of
    texts with one doc_id the least text hash. A document is a doc_id with a
    text; equal ones stay once. Rows without a doc_id all stay."""
    own, doc_id, text = plain(docs)
    numbered = own.withColumns({"_number": F.col(doc_id).cast("bigint"), "_id": F.col(doc_id).cast("bigint"), "_hash": text_hash(text)})
    known = numbered.where(F.col("_id").isNotNull()).select("_id", F.col("_hash").alias("_h"))
    texts = written(known.groupBy("_id", "_h").agg(F.count(F.lit(1)).alias("_rows")), "texts-of-ids")
    least = texts.groupBy("_id").agg(F.min("_h").alias("_least"), F.count(F.lit(1)).alias("_texts")).where(F.col("_texts") > 1)
    # The join works by number: further texts of a doc_id get numbers of their own.
    further = texts.join(least, "_id").where(F.col("_h") != F.col("_least")).select(F.col("_id").alias("_i"), "_h", F.xxhash64("_id", "_h").alias("_own"))
    further = written(further, "further-texts")
    if not further.isEmpty():
        same = (F.col("_id") == F.col("_i")) & (F.col("_hash") == F.col("_h"))
        numbered = numbered.join(further, same, "left").withColumn("_number", F.coalesce("_own", "_number")).drop("_i", "_h", "_own")
    found = parity_join.jaccard_components(numbered.select(F.col("_number").alias("doc_id"), F.col(text).alias("text")))
    found = found.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_member"), "component_id").distinct()
    if further.isEmpty():
        gone = found.where(F.col("component_id") != F.col("_member")).select("_member")
    else:
        found = written(found.join(further, F.col("_member") == F.col("_own"), "left"), "members")
        rank = F.struct(F.coalesce("_i", "_member"), F.col("_h"))  # a null hash, of the least text, comes first
        first = found.groupBy("component_id").agg(F.min_by("_member", rank).alias("_first"))
        gone = found.join(first, "component_id").where(F.col("_member") != F.col("_first")).select("_member")
    kept = numbered.join(gone, F.col("_number") == F.col("_member"), "left_anti")
    repeated = texts.where(F.col("_rows") > 1).select(F.col("_id").alias("_i"), F.col("_h").alias("_x"))
    if not repeated.isEmpty():
        equal = (F.col("_id") == F.col("_i")) & (F.col("_hash") == F.col("_x"))
        once = kept.join(repeated, equal, "left_semi").dropDuplicates(["_number"])
        kept = kept.join(repeated, equal, "left_anti").unionByName(once)
    return kept.select(*own.columns).toDF(*docs.columns)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_n``, their number from 1 among those of one (_id, _h, _s):
    counted per partition of the scan first, so that however many rows are equal
    (as those without an id), no task holds them all."""
    key = ["_id", "_h", "_s", "_part"]
    rows = rows.withColumn("_part", F.shiftright("_row", 33))  # the partition that numbered the row
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_held"))
    earlier = Window.partitionBy(*key[:3]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"{k}2") for k in key], F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_start"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}2"))
    inside = F.row_number().over(Window.partitionBy(*key).orderBy("_row"))
    return rows.withColumn("_n", inside).join(written(starts, "mix-starts"), same).withColumn("_n", F.col("_start") + F.col("_n"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Equal rows (of doc_id, text
    and source) share what the mix takes of them: as many copies in all."""
    own, doc_id, text = plain(docs)
    source = own.columns[docs.columns.index("source")]
    plan = mixing.mix(docs).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"), F.col("source").alias("_s"))
    plan = written(plan.agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).where(F.col("_copies") > 0), "mix-copies")
    here = F.col(doc_id).eqNullSafe(F.col("_id")) & (text_hash(text) == F.col("_h")) & F.col(source).eqNullSafe(F.col("_s"))
    joined = own.withColumn("_row", F.monotonically_increasing_id()).join(plan, here)
    if not plan.where(F.col("_rows") > 1).isEmpty():
        many = _numbered(joined.where(F.col("_rows") > 1))
        each = F.floor(F.col("_copies") / F.col("_rows")) + (F.col("_n") <= F.col("_copies") % F.col("_rows")).cast("int")
        many = many.withColumn("_copies", each.cast("bigint")).where(F.col("_copies") > 0)
        joined = joined.where(F.col("_rows") == 1).unionByName(many.select(*joined.columns))
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))
    return joined.withColumn("_copy", F.explode(copies)).select(*own.columns).toDF(*docs.columns)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed along the curve."""
    return hilbert_pack.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("packing", pack_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
