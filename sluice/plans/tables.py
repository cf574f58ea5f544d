"""Inputs that queries derive from the test tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a wall-clock timestamp, whatever the session zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records: topic by type, partition by user, offset = event id.

    Offsets in one topic-partition rise with gaps, as after compaction, so no
    numbering over a whole topic-partition is needed.
    """
    e = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    event_text, tenant = event.cast("string"), F.concat(F.lit("t"), (user % 3).cast("string"))

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))

    plain = F.array(header("tenant", tenant), header("trace", event_text))
    repeated = F.array(header("tenant", tenant), header("trace", event_text), header("tenant", F.lit("dup")))
    return e.select(
        F.when(event % 10 != 0, F.concat(F.lit('{"user_id": '), user.cast("string"), F.lit("}")))
        .cast("binary")
        .alias("key"),
        F.when(
            event % 25 != 0,
            F.concat(F.lit('{"event_id": '), event_text, F.lit(', "props": '), F.col("props"), F.lit("}")),
        )
        .cast("binary")
        .alias("value"),
        F.concat(F.lit("ev."), "event_type").alias("topic"),
        (user % 4).cast("int").alias("partition"),
        event.alias("offset"),
        F.col("ts").alias("timestamp"),
        F.when(event % 7 != 0, F.when(event % 11 == 0, repeated).otherwise(plain)).alias("headers"),
    )


RECORDS_SQL = """
records AS (
  SELECT
    CASE WHEN event_id % 10 <> 0 THEN '{"user_id": ' || user_id || '}' END AS key,
    CASE WHEN event_id % 25 <> 0 THEN '{"event_id": ' || event_id || ', "props": ' || props || '}' END AS value,
    'ev.' || event_type AS topic,
    CAST(user_id % 4 AS INTEGER) AS partition,
    event_id AS "offset",
    epoch_us(ts) // 1000 AS ts_ms,
    CASE WHEN event_id % 7 = 0 THEN NULL
         WHEN event_id % 11 = 0 THEN 'dup'
         ELSE 't' || (user_id % 3) END AS tenant,
    CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR) END AS trace
  FROM events
)
"""
