"""Adapter view ``event_log`` over the driver's ``events`` table.

The driver ships a generic ``events`` table (event_id, ts, user_id,
event_type, value, props). This view only renames and re-types it into the
event-log schema the jobs expect; it does none of the jobs' work. The
expressions are the ones fixed in FIXTURES.md section 3, plus a few
per-device stand-in columns for ids the driver table lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _bad_row_udmap(event_id: Column, props: Column) -> Column:
    # The eight udmap variants by event_id % 8 (FIXTURES section 3).
    m = event_id % 8
    return (F.when(m == 0, F.lit(None).cast("string"))
            .when(m == 1, F.lit(""))
            .when(m == 2, F.lit("{}"))
            .when(m == 3, F.lit("bad"))
            .when(m == 4, F.lit("[1]"))
            .when(m == 5, F.lit('{"botId":12,"pluginId":"p","z":1}'))
            .when(m == 6, F.lit('{"botId":null,"a":2}'))
            .otherwise(props))


def event_log_from_events(events: DataFrame, udmap: str = "props") -> DataFrame:
    """Map ``events`` rows onto the event-log schema (plus row_id, split)."""
    e = events
    eid_mod = lambda k: F.col("event_id") % k
    appver = (F.when(eid_mod(11) == 0, F.lit("x"))
              .when(eid_mod(11) == 1, F.lit(None).cast("string"))
              .otherwise(F.floor("value").cast("bigint").cast("string")))
    udmap_col = (_bad_row_udmap(F.col("event_id"), F.col("props"))
                 if udmap == "bad_rows" else F.col("props"))
    uid = F.col("user_id")
    return e.select(
        F.col("event_id").alias("row_id"),
        uid.cast("string").alias("did"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("eid"),
        F.nullif(uid % 7, F.lit(0)).cast("smallint").alias("device_brand"),
        (uid % 3).cast("tinyint").alias("ntt"),
        (uid % 4).cast("tinyint").alias("operator"),
        (uid % 2).cast("smallint").alias("common_country"),
        (uid % 31).cast("smallint").alias("common_province"),
        (uid % 97).cast("smallint").alias("common_city"),
        appver.alias("appver"),
        eid_mod(13).cast("smallint").alias("channel"),
        (uid % 5).cast("tinyint").alias("os_type"),
        # wall-clock micros since the epoch, independent of the session time zone
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000")
        .alias("common_ts"),
        udmap_col.alias("udmap"),
        (F.col("event_type") == "signup").cast("tinyint").alias("is_new_did"),
        F.when(eid_mod(5) == 0, "test").otherwise("train").alias("split"),
    )


def event_log(spark: SparkSession, sf_dir: str, udmap: str = "props") -> DataFrame:
    return event_log_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), udmap)


def bucketed_events(events: DataFrame, buckets: int, key: str = "did",
                    path: str | None = None) -> DataFrame:
    """Store ``events`` once in ``buckets`` files by ``key``, sorted by it, and read them as a table.

    Aggregates by ``key`` and joins on it then need no exchange of the events, on any
    number of later runs. ``path`` is in the shared folder unless given; nulls share a
    bucket. Deal out a key with far more rows than a bucket beforehand (rows stay whole
    for each key): a bucket is read by one task.
    """
    import uuid

    from eventcraft.sources.csv_io import scratch_path
    spark = events.sparkSession
    name = f"events_{uuid.uuid4().hex[:12]}"
    events.write.bucketBy(buckets, key).sortBy(key).option(
        "path", path or scratch_path(spark, "bucketed")).saveAsTable(name)
    return spark.table(name)


# DuckDB twin of the adapter, used only by the oracle SQL.
EVENT_LOG_SQL = """
event_log AS (
  SELECT event_id AS row_id,
         CAST(user_id AS VARCHAR) AS did,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         event_type AS eid,
         CAST(NULLIF(user_id % 7, 0) AS SMALLINT) AS device_brand,
         CAST(user_id % 3 AS TINYINT) AS ntt,
         CAST(user_id % 4 AS TINYINT) AS operator,
         CAST(user_id % 2 AS SMALLINT) AS common_country,
         CAST(user_id % 31 AS SMALLINT) AS common_province,
         CAST(user_id % 97 AS SMALLINT) AS common_city,
         CASE event_id % 11 WHEN 0 THEN 'x' WHEN 1 THEN NULL
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS appver,
         CAST(event_id % 13 AS SMALLINT) AS channel,
         CAST(user_id % 5 AS TINYINT) AS os_type,
         epoch_us(ts) // 1000 AS common_ts,
         {udmap} AS udmap,
         CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS TINYINT) AS is_new_did,
         CASE event_id % 5 WHEN 0 THEN 'test' ELSE 'train' END AS split
  FROM events)
"""

BAD_ROW_UDMAP_SQL = """CASE event_id % 8
           WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '{}' WHEN 3 THEN 'bad'
           WHEN 4 THEN '[1]' WHEN 5 THEN '{"botId":12,"pluginId":"p","z":1}'
           WHEN 6 THEN '{"botId":null,"a":2}' ELSE props END"""


def event_log_sql(udmap: str = "props") -> str:
    return EVENT_LOG_SQL.format(udmap=BAD_ROW_UDMAP_SQL if udmap == "bad_rows" else "props")
