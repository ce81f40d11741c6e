"""Run caches, timelines, atlases and frame strips as DataFrames.

Everything goes through Spark's readers and writers, so any store Spark knows
will do. Schemas are given, never inferred: header values mix numbers and text,
which an inferred schema would coerce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_RUNS = "field string, value string, start double, `end` double, samples bigint"
_BOARD_VALUE = "number int, name string, kills int, deaths int, streak int, stat string, stat_label string, gutter string, spectated boolean"
BOARD_RUNS = f"side string, slot int, start double, `end` double, samples bigint, value struct<{_BOARD_VALUE.replace(' ', ':').replace(',:', ',')}>"
STATES = "t double, state string, name_rows int, name_pitches array<int>, chrome boolean, tag string, tag_distance int, series_orange double, boxscore_columns int"
_BITMAP = "struct<h:int,w:int,b:string>"
SIGHTINGS = "t double, slot int, signature array<int>, x array<int>, " + ", ".join(f"{k}_bmp {_BITMAP}" for k in ("attacker", "weapon", "victim", "medal"))
TIMELINE = "state string, start double, `end` double, duration double, n_samples bigint"
BOX_SCORES = "map int, t double, mode string, start double, `end` double, kd map<string,struct<kills:int,deaths:int>>"
GLYPH_ATLAS = "font string, canvas array<int>, threshold int, glyphs map<string,array<string>>"
TEMPLATE_SET = "name string, templates map<string,array<string>>"
NAME_SET = "name string, teams map<string,string>, templates map<string,array<array<string>>>"
#: Bitmaps that kernels may hold at once.
MOST_BITMAPS = 100_000


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or gzipped; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def write_lines(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.mode("overwrite").option("compression", compression).json(path)


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document or array per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def timed(runs: DataFrame, vod: str | None = None) -> DataFrame:
    """Cache columns start and end under the engine's names, with the nested
    value flattened and the broadcast named."""
    out = runs.withColumnsRenamed({"start": "start_t", "end": "end_t"})
    if "value" in runs.columns and runs.schema["value"].dataType.typeName() == "struct":
        out = out.select(*[c for c in out.columns if c != "value"], "value.*")
    return out.withColumn("vod", F.lit(vod)) if vod is not None else out


def state_spans(spark: SparkSession, path: str, state: str) -> DataFrame:
    """(start_t, end_t) of a timeline's segments of one state."""
    rows = read_document(spark, path, TIMELINE).where(F.col("state") == state)
    return rows.select(F.col("start").alias("start_t"), F.col("end").alias("end_t"))


def box_totals(spark: SparkSession, path: str) -> DataFrame:
    """(map, t, name, kills, deaths): a row per player of each box score."""
    rows = read_document(spark, path, BOX_SCORES).select("map", "t", F.explode("kd").alias("name", "x"))
    return rows.select("map", "t", "name", "x.kills", "x.deaths")


def read_atlas(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(label, variant, rows, h, w) of an atlas: kind 'glyph', 'template' or
    'name'. Bitmaps are drawn with '#' and '.'."""
    if kind == "glyph":
        found = read_document(spark, path, GLYPH_ATLAS).select(F.explode("glyphs").alias("label", "rows")).withColumn("variant", F.lit(0))
    elif kind == "template":
        found = read_document(spark, path, TEMPLATE_SET).select(F.explode("templates").alias("label", "rows")).withColumn("variant", F.lit(0))
    else:
        named = read_document(spark, path, NAME_SET).select(F.explode("templates").alias("label", "all"))
        found = named.select("label", F.posexplode("all").alias("variant", "rows"))
    return found.select("label", "variant", "rows", F.size("rows").alias("h"), F.coalesce(F.char_length(F.try_element_at("rows", F.lit(1))), F.lit(0)).alias("w"))


def bitmaps_of(atlas: DataFrame) -> dict:
    """label -> bitmaps of an atlas, for the kernels. It goes to every worker, so
    one of more than ``MOST_BITMAPS`` is an error; none is left out."""
    from ..functions.bitmaps import from_rows

    rows = atlas.limit(MOST_BITMAPS + 1).collect()
    if len(rows) > MOST_BITMAPS:
        raise ValueError(f"an atlas may hold {MOST_BITMAPS} bitmaps at most; join larger ones as a table")
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r.label, r.variant)):
        out.setdefault(r.label, []).append(from_rows(r.rows))
    return out


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    return read_document(spark, path, NAME_SET).select(F.explode("teams").alias("name", "side"))


def packed_length(bitmap):
    """Bytes of a packed bitmap column, to check it against its shape."""
    return F.octet_length(F.unbase64(bitmap["b"]))


def check_even(x, y, width, height):
    """Crops must have even edges; null where they do, else an error text."""
    odd = (x % 2 != 0) | (y % 2 != 0) | (width % 2 != 0) | (height % 2 != 0)
    return F.when(odd, F.lit("crop edges must be even"))


def write_strip(frames: DataFrame, path: str, fps: float, start: float = 0.0, source: str = "") -> None:
    """A strip: cropped frames (region, frame, pixels) by region, cut into
    ranges of frames so that readers take disjoint ones, with its metadata."""
    ranged = frames.withColumn("block", F.floor(F.col("frame") / 1024))
    ranged.repartition("region", "block").sortWithinPartitions("region", "frame").write.mode("overwrite").partitionBy("region").parquet(f"{path}/frames")
    meta = frames.groupBy("region").agg(F.max("frame").alias("last"), F.count(F.lit(1)).alias("frames"))
    meta.select("region", F.lit(source).alias("source"), F.lit(float(fps)).alias("fps"), F.lit(float(start)).alias("start"), "frames").coalesce(1).write.mode("overwrite").json(f"{path}/sidecar")


def read_strip(spark: SparkSession, path: str, region: str, first: int = 0, count: int | None = None) -> DataFrame:
    """(t, frame, pixels): a range of a strip. Region and range are pushed to
    the scan."""
    meta = spark.read.schema("region string, source string, fps double, start double, frames bigint").json(f"{path}/sidecar").where(F.col("region") == region)
    fps, start = meta.select("fps", "start").first()
    out = spark.read.parquet(f"{path}/frames").where((F.col("region") == region) & (F.col("frame") >= first))
    if count is not None:
        out = out.where(F.col("frame") < first + count)
    return out.select((F.lit(start) + F.col("frame") / F.lit(fps)).alias("t"), "frame", "pixels")
