"""Target-distribution importance resampling without exploding documents
(DataFrame functions only).

Method: higher-order functions turn a text into the array of the buckets of its
word n-grams (CRC-32 modulo ``BUCKETS``). Counts of the buckets over the corpus
and over the target texts give each bucket a gain, the scaled logarithm of the
ratio of the two smoothed shares. The gains are one literal array of
``BUCKETS`` entries; a document's weight is an aggregate over its own array
that looks each bucket up by place. Nothing of a document is exploded for its
score. Gumbel noise from a digest of the doc_id makes the highest scores a
sample without replacement that favours documents like the target.

Scale: texts are read once; the bucket arrays are written (two bytes a word
before compression), as both the counts and the scores need them. Counting
combines inside each task, so at most ``BUCKETS`` totals a task are shuffled,
and ``BUCKETS`` totals are the only thing the driver reads. The drawn documents
are ranked in ranges of score and doc_id: a narrow table is range-partitioned,
ranges are counted, and only ranges that hold drawn documents are numbered. A
row number parts equal rows, so no key can fill one task.

Nulls: a null or wordless text has no features and weight 0. A null doc_id has
no score; it is neither drawn nor counted among those drawn from, but its
features count. Rows that repeat a doc_id are separate documents; equal ones
are ranked in any order. Other columns are ignored. An empty table gives an
empty table; without target texts all gains follow from smoothing alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, table, written

#: What parts words, after A-Z are lower-cased: all ASCII but digits and a-z.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = "2024"
#: Documents of a range of scores: at least so many where there are few, at most about so many.
FEW_ROWS, MANY_ROWS = 4096, 500_000
#: The order of the draw; the row's number parts equal rows.
ORDER = (F.desc, "score"), (F.asc, "doc_id"), (F.asc, "row")


def words(text: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD, -1)
    # Only the first and the last part can be empty.
    return F.filter(parts, lambda w: w != "")


def bucket_array(found: Column, most_words: int = 1) -> Column:
    """Buckets of all runs of 1 to ``most_words`` consecutive words of an array."""
    bucket = lambda x: F.pmod(F.crc32(x.cast("binary")), F.lit(BUCKETS)).cast("smallint")

    def runs(n: int) -> Column:
        starts = F.when(F.size(found) >= n, F.sequence(F.lit(1), F.size(found) - F.lit(n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: bucket(F.array_join(F.slice(found, i, F.lit(n)), " ")))

    return F.concat(F.transform(found, bucket), *map(runs, range(2, most_words + 1)))


def featured(docs: DataFrame, most_words: int, *columns: Column) -> DataFrame:
    """(columns, n_words, buckets) of each row, by its column ``text``."""
    split = docs.select(*columns, words(F.col("text")).alias("words"))
    return split.select(*[c for c in split.columns if c != "words"], F.size("words").cast("long").alias("n_words"), bucket_array(F.col("words"), most_words).alias("buckets"))


def totals(featured: DataFrame) -> list[int]:
    """How often each bucket occurs, by bucket."""
    counts = featured.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    out = [0] * BUCKETS
    for row in counts.collect():  # at most BUCKETS rows
        out[row[0]] = row[1]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Of each bucket, 1000 times the logarithm of target share over corpus share."""
    s_all, t_all = sum(corpus) + BUCKETS, sum(target) + BUCKETS
    ratio = lambda s, t: float(t + 1) * float(s_all) / (float(s + 1) * float(t_all))
    return [math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(corpus, target, strict=True)]


def literal(values: list[int]) -> Column:
    """A literal array; folded once by the optimizer, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def noise(doc_id: Column, seed: str) -> Column:
    """1000 times a standard Gumbel number, rounded down, from a digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, most_words: int = 1, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), one row a document."""
    made = written(featured(docs, most_words, F.col("doc_id").cast("bigint").alias("doc_id")), "importance-buckets")
    gain = literal(gains(totals(made), totals(featured(target, most_words))))
    weight = F.aggregate("buckets", F.lit(0).cast("long"), lambda total, b: total + F.element_at(gain, b.cast("int") + 1))
    out = made.select("doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), weight.alias("weight"))
    return out.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def draw(rows: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``rows`` (of ``scored``) with ``rank``: 1, 2, ... for the highest scores
    among documents of enough words, ``percent`` of these; else null."""
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    fit = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    n_fit = rows.where(fit).count()
    n_drawn = percent * n_fit // 100
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = max(1, min(usual, -(-n_fit // FEW_ROWS)), -(-n_fit // MANY_ROWS))
    order = [way(c) for way, c in ORDER]
    cut = written(rows.where(fit).repartitionByRange(n_ranges, *order).withColumn("part", F.spark_partition_id()), "importance-ranges")
    sums = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(sums.select("part", before.alias("start")), "importance-starts")  # one row a range
    placed = cut.join(starts, "part")
    ranked = placed.where(F.col("start") < n_drawn).withColumn("rank", F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")).cast("long"))
    none = F.lit(None).cast("long").alias("rank")
    kept = [c for c in rows.columns if c != "row"]
    late = placed.where(F.col("start") >= n_drawn).select(*kept, none)
    return ranked.select(*kept, "rank").unionByName(late).unionByName(rows.where(~fit).select(*kept, none))


def op13_importance(spark, sf_dir: str) -> DataFrame:
    """Per document: features, weight, score, and rank if drawn."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = draw(scored(docs, target), percent=10, least_words=20)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
           lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), g AS (
  SELECT unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS word
  FROM benchmark
), e AS (SELECT doc_id, unnest(words) AS word FROM d
), v AS (SELECT DISTINCT word FROM (SELECT word FROM e UNION ALL SELECT word FROM g)
), b AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(hex(encode(word))), 2),
           lambda i: ('0x' || substr(hex(encode(word)), i + 1, 2))::BIGINT)),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM v, crc
), s AS (SELECT bucket, count(*) AS n FROM e JOIN b USING (word) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS n FROM g JOIN b USING (word) GROUP BY bucket
), k AS (
  SELECT r.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
           / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), w AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM e JOIN b USING (word) JOIN k USING (bucket) GROUP BY doc_id
), x AS (
  SELECT d.doc_id, len(d.words)::BIGINT AS n_features, coalesce(w.weight, 0) AS weight,
         (coalesce(w.weight, 0) + floor(-1000.0 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN w USING (doc_id)
), o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rn, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT x.doc_id, n_features, weight, score, CASE WHEN rn <= 10 * n // 100 THEN rn END AS rank
FROM x LEFT JOIN o USING (doc_id)
"""
