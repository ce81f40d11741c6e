"""The engine's views of the star-schema tables.

``events`` is read as sightings: user_id is the key, event_type the state,
value a counter and k a number from the JSON properties; t is in seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import seconds

DAY, HOUR, MINUTE = 86_400.0, 3_600.0, 60.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return read(spark, sf_dir, "events").select("event_id", "user_id", seconds(F.col("ts")).alias("t"), "event_type", "value", k.alias("k"))


def typed(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == kind)


#: The same view for the oracles.
EVENTS = """e AS (
  SELECT event_id, user_id, epoch_us(ts)::DOUBLE / 1e6 AS t, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
)"""
RUNS = (
    EVENTS
    + """, b AS (
  SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(event_id) OVER w IS NULL THEN 1 ELSE 0 END AS brk
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)
), n AS (
  SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM b
), r AS (
  SELECT user_id, run::BIGINT AS run, min(event_type) AS event_type, min(t) AS start_t, max(t) AS end_t, count(*)::BIGINT AS samples
  FROM n GROUP BY user_id, run
)"""
)
