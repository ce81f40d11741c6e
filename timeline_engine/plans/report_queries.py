"""Reports: contradictory probes, frequent geometry, fuzzy votes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import fuzzy as Z
from .inputs import EVENTS, events, read


def contradictory_probes(spark, sf_dir):
    """Probe rows that contradict each other, by kind, with the first instant."""
    k, tag = F.col("k"), F.col("event_type") == "error"
    grid, chrome, orange = F.coalesce(k % 11 == 0, F.lit(False)), F.coalesce(k % 2 == 0, F.lit(False)), F.col("value") / 100
    kinds = {"tag": tag, "tag without chrome": tag & ~chrome, "tag and grid": tag & grid, "orange over chrome": (orange > 0.15) & chrome, "odd rows": (k % 6).isin(3, 5)}
    # Each row names the kinds it shows; counts combine before the shuffle.
    named = F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit(False)), F.lit(x)) for x, v in kinds.items()]))
    out = events(spark, sf_dir).select("t", F.explode(named).alias("probe"))
    return out.groupBy("probe").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"))


def geometry_topk(spark, sf_dir):
    """The five most frequent bands (k modulo 9 to value's ten) of each type that
    are at least two high."""
    a, b = F.col("k") % 9, F.floor(F.col("value") / 10).cast("bigint")
    bands = events(spark, sf_dir).select("event_type", a.alias("lo"), b.alias("hi")).where(F.col("hi") - F.col("lo") >= 2)
    n = bands.groupBy("event_type", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("event_type").orderBy(F.desc("n"), "lo", "hi")
    return n.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= 5)


def _misread(spark, sf_dir):
    """Part names as two noisy readings each: a character lost, two swapped."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), (F.col("p_size") / 50).cast("double").alias("confidence"))
    at = (F.col("p_partkey") % F.char_length("name")).cast("int")
    lost = F.concat(F.substring("name", F.lit(1), at), F.substring("name", at + 2, F.char_length("name")))
    swapped = F.translate("name", "eo", "oe")
    return p.select("p_partkey", "brand", "confidence", F.explode(F.array(lost, swapped)).alias("text"))


def fuzzy_names(spark, sf_dir):
    """The name that each brand's noisy readings speak for most."""
    names = read(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    votes = Z.fuzzy_votes(_misread(spark, sf_dir), names, ["brand"], ["p_partkey"])
    best = votes.groupBy("brand").agg(F.min(F.struct((-F.round("score", 6)).alias("s"), F.col("name"))).alias("b"), F.count(F.lit(1)).alias("names"))
    return best.select("brand", F.col("b.name").alias("name"), (-F.col("b.s")).alias("score"), "names")


QUERIES = {f.__name__: f for f in (contradictory_probes, geometry_topk, fuzzy_names)}

ORACLE_SQL = {
    "contradictory_probes": f"""WITH {EVENTS}, p AS (
  SELECT t, event_type = 'error' AS tag, coalesce(k % 11 = 0, false) AS grid, coalesce(k % 2 = 0, false) AS chrome, value / 100 > 0.15 AS orange, k % 6 AS rows_ FROM e
), u AS (
  SELECT t, 'tag' AS probe FROM p WHERE tag UNION ALL SELECT t, 'tag without chrome' FROM p WHERE tag AND NOT chrome UNION ALL SELECT t, 'tag and grid' FROM p WHERE tag AND grid
  UNION ALL SELECT t, 'orange over chrome' FROM p WHERE orange AND chrome UNION ALL SELECT t, 'odd rows' FROM p WHERE rows_ IN (3, 5)
) SELECT probe, count(*)::BIGINT AS n, min(t) AS first_t FROM u GROUP BY probe""",
    "geometry_topk": f"""WITH {EVENTS}, b AS (SELECT event_type, k % 9 AS lo, floor(value / 10)::BIGINT AS hi FROM e), n AS (SELECT event_type, lo, hi, count(*)::BIGINT AS n FROM b WHERE hi - lo >= 2 GROUP BY ALL)
SELECT event_type, lo, hi, n, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, lo, hi) AS rank FROM n QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY n DESC, lo, hi) <= 5""",
}
