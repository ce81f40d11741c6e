"""Exact line deduplication across documents (DataFrame functions only).

Method: every line long enough becomes a row (two 64-bit hashes of its key,
document, position). The rows are range-partitioned by hash and sorted inside
each partition by hash, document and position, so that a window with a running
frame streams over each key and sees its first document first. Later documents'
lines are marked, and the marks return as per-document bitmaps; texts never
travel with the lines.

Skew: keys are counted in 65,536 hash buckets (at most that many rows per map
task). Lines in a bucket far above the mean get a salt from their document, so
a frequent line is cut into many ranges: of n lines, into about the root of n.
Within one salt a later document is certainly a repeat; the first documents of a
salted key, at most one a salt, then go through a second round of about the
root of n rows.

Nulls: a null text is one empty line. A null doc_id is a document of its own
that precedes all others. Rows that repeat a doc_id count as one document for
the "two documents" rule and each keep their own bitmap (by a hash of the
text); equal rows get equal results. Other columns pass through, whatever
their names. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WS_CHARS, by_ranges, own, table, written

BUCKETS = 65_536
#: A bucket is salted from this many times the mean, and this many lines, on.
HOT_FACTOR, HOT_LEAST = 4, 1_000
#: Lines of a range of hashes, about, at most.
RANGE_LINES = 4_000_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WS_CHARS)), UPPER, LOWER)


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, text_hash, keep, n_dropped) of each document that loses lines.

    ``keep`` lists the 64-line words of the keep bitmap that are not all ones,
    as (word, bits), by word; an absent word keeps its 64 lines.
    """
    # The hash is made below the generator, which would else make it per line.
    texts = docs.select(F.col("doc_id"), _text_hash(F.col("text")).alias("text_hash"), _lines(F.col("text")).alias("lines"))
    lines = texts.select("doc_id", "text_hash", F.posexplode("lines").alias("pos", "line"))
    key = line_key(F.col("line"))
    lines = (
        lines.select("doc_id", "text_hash", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2"))
    )
    lines = written(lines, "line-hashes")
    bucket = F.col("h1").bitwiseAND(F.lit(BUCKETS - 1))
    sizes = lines.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    n_lines = lines.count()
    hot = sizes.where(F.col("n") > max(HOT_LEAST, HOT_FACTOR * n_lines / BUCKETS)).select("bucket", F.ceil(F.sqrt("n")).cast("long").alias("salts"))
    # At most BUCKETS rows of one number, whatever the input: safe to broadcast.
    salted = lines.withColumn("bucket", bucket).join(F.broadcast(hot), "bucket", "left")
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("salts")), F.lit(-1)).cast("long")
    salted = salted.select("h1", "h2", salt.alias("salt"), "doc_id", "text_hash", "pos")

    ranged = by_ranges(salted, n_lines, RANGE_LINES, "h1", "h2", "salt")
    stream = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = ranged.withColumn("first_doc", F.first("doc_id").over(stream))
    repeat = ~F.col("doc_id").eqNullSafe(F.col("first_doc"))
    again = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    second = first.where(~repeat & (F.col("salt") >= 0)).select("h1", "h2", "doc_id", "text_hash", "pos").withColumn("first_doc", F.first("doc_id").over(again))
    dropped = first.where(repeat).select("doc_id", "text_hash", "pos").unionByName(second.where(repeat).select("doc_id", "text_hash", "pos"))

    dropped = dropped.repartition("doc_id", "text_hash")
    words = dropped.groupBy("doc_id", "text_hash", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("mask")
    )
    return words.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct(F.col("word"), F.bitwise_not("mask").alias("bits")))).alias("keep"),
        F.sum(F.bit_count("mask")).cast("long").alias("n_dropped"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, names: tuple[str, str, str] = ("n_lines", "n_dropped", "kept")) -> DataFrame:
    """The documents with three columns added, or replaced: the number of lines,
    of dropped lines, and the text of the kept ones."""
    # The bitmap as an array of all words up to the last listed one, so that a
    # line finds its word by place: one bit a line. Made before the join, as in
    # the projection after it, it would be made again for every line.
    before = lambda i: F.when(i > 0, F.element_at("keep", F.greatest(i, F.lit(1)))["word"] + 1).otherwise(F.lit(0))
    whole = F.flatten(F.transform("keep", lambda w, i: F.concat(F.array_repeat(F.lit(-1).cast("long"), w["word"] - before(i)), F.array(w["bits"]))))
    b = bitmaps.select("doc_id", "text_hash", "n_dropped", whole.alias("words")).alias("b")
    text = F.col("d.text")
    joined = docs.alias("d").join(b, F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (_text_hash(text) == F.col("b.text_hash")), "left")
    lines = _lines(text)

    def stays(_line: Column, i: Column) -> Column:
        bits = F.coalesce(F.try_element_at("b.words", F.shiftright(i, 6) + 1), F.lit(-1).cast("long"))
        return F.getbit(bits, i.bitwiseAND(F.lit(63))) == 1

    kept = F.when(F.col("b.words").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return joined.select(
        *own(docs, *names, at="d"),
        F.size(lines).cast("long").alias(names[0]),
        F.coalesce(F.col("b.n_dropped"), F.lit(0)).cast("long").alias(names[1]),
        kept.alias(names[2]),
    )


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: lines before dropping, lines dropped, digest of the rest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), f AS (
  SELECT key, min(doc_id) AS first_doc, max(doc_id) AS last_doc
  FROM k WHERE length(key) >= 10 GROUP BY key
), m AS (
  SELECT k.doc_id, k.pos, k.line, (f.key IS NOT NULL AND k.doc_id > f.first_doc) AS dropped
  FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
