"""Queries over events as records, and the SQL that checks each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.durations import duration_millis, whole_seconds
from sluice.functions.headers import header_text
from sluice.functions.json_text import canonical_json, json_scalar
from sluice.operators.bundling import bundle_records, number_bundles
from sluice.operators.records import Shaping, direct_records, shape_records, with_header_key, with_route
from sluice.plans.tables import RECORDS_SQL, epoch_millis, records, table
from sluice.sources.records import (
    batch_counts,
    from_positions,
    next_offsets,
    topic_names,
    with_batches,
    with_topic_pattern,
    with_topics,
)
from sluice.session import work_folder, written
from sluice.sources.landed import land_log
from sluice.streaming.ingest import drain, ingest, land_records, resume_landed, written_rows

POLL, COUNT, SIZE = 2000, 20, 600
TENANT = Shaping(predicate="offset % 6 <> 0", header_regex="tenant")
BROKERS = "localhost:9092"


def _plain(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"), epoch_millis(F.col("timestamp")).alias("ts_ms"),
    )


def record_topics_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(with_topics(records(spark, sf), " ev.click, ev.view,, ev.vie "))


def record_topics_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(with_topic_pattern(records(spark, sf), r"ev\.(purchase|sign.*)"))


def record_topic_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Topic lists that come as data: names per event, more than a hundred for some."""
    many = F.transform(F.sequence(F.lit(1), F.col("user_id") % 200 + 1), lambda i: F.concat(F.lit("t"), i.cast("string")))
    listing = F.concat_ws(" ,", F.col("event_type"), F.lit(""), many, F.col("user_id").cast("string"), F.lit("  "))
    return table(spark, sf, "events").select(
        "event_id", F.array_join(topic_names(listing), "|").alias("names"), F.size(topic_names(listing)).alias("n")
    )


def _committed(spark: SparkSession, sf: str) -> DataFrame:
    seen = next_offsets(records(spark, sf)).where("partition <> 3")
    return written(seen.withColumn("next_offset", F.expr("next_offset div 2")), "committed")


def record_from_offset(spark: SparkSession, sf: str) -> DataFrame:
    r, c = records(spark, sf), _committed(spark, sf)
    parts = [
        from_positions(r, c, reset).select(F.lit(reset).alias("reset"), "topic", "partition", "offset")
        for reset in ("earliest", "latest")
    ]
    return parts[0].unionByName(parts[1])


def record_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batch_counts(with_batches(records(spark, sf), POLL))


def record_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return shape_records(records(spark, sf)).select(
        "topic", "partition", "offset", "content", "malformed"
    )


def record_text_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys taken as plain text, values as JSON in which equal names are refused."""
    rule = Shaping(decode_key=lambda c: F.when(c.isNotNull(), json_scalar(c.cast("string"))), duplicate_keys="reject")
    return shape_records(records(spark, sf), rule).select("topic", "partition", "offset", "key_text", "content")


def _json_forms(spark: SparkSession, sf: str) -> DataFrame:
    key, name = F.col("c_custkey"), F.col("c_name")
    number = key.cast("string")
    return table(spark, sf, "customer").select(
        key,
        F.when(key % 10 == 0, F.concat(F.lit('{ "id" : '), number, F.lit(' , "tags":[ 1, "x" ,null] }')))
        .when(key % 10 == 1, F.concat(F.lit('"'), name, F.lit('\\"q"')))
        .when(key % 10 == 2, F.lit(" null "))
        .when(key % 10 == 3, F.concat(F.lit('{"id":'), number))
        .when(key % 10 == 4, F.concat(F.lit('{"id":'), number, F.lit(', "b":{"x":1,"x":'), number, F.lit('}, "id": 0}')))
        .when(key % 10 == 5, F.concat(F.lit("[ true,"), number, F.lit(".50 ]")))
        .when(key % 10 == 6, F.concat(F.lit("{'id':"), number, F.lit("}")))
        .when(key % 10 == 7, F.concat(F.lit('{"id":'), number, F.lit("} rest")))
        .when(key % 10 == 8, F.lit("")).alias("text"),
    )


def record_json_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Any JSON shape in compact form; the last of equal names wins, malformed text is NULL."""
    return _json_forms(spark, sf).select("c_custkey", canonical_json(F.col("text")).alias("json"))


def record_headers(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for label, regex in (("tenant", "tenant"), ("all", ".*"), ("none", None)):
        one = shape_records(records(spark, sf), Shaping(header_regex=regex)).select(
            F.lit(label).alias("selection"), "offset", header_text(F.col("headers")).alias("headers")
        )
        out = one if out is None else out.unionByName(one)
    return out


def record_direct(spark: SparkSession, sf: str) -> DataFrame:
    out = direct_records(shape_records(records(spark, sf), TENANT), "PLAINTEXT", BROKERS)
    return out.select(
        "topic", "partition", "offset", epoch_millis(F.col("timestamp")).alias("ts_ms"), "matched", "route", "bundled",
        "record_count", "record_size", "mime_type", "origin", header_text(F.col("headers")).alias("headers"), "content",
    )


def record_routes(spark: SparkSession, sf: str) -> DataFrame:
    return (
        with_route(shape_records(records(spark, sf), TENANT)).groupBy("topic", "partition", "route")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("offset").alias("offset_sum"))
    )


def bundle_runs(spark: SparkSession, sf: str) -> DataFrame:
    shaped = with_header_key(shape_records(with_batches(records(spark, sf), POLL), TENANT))
    return number_bundles(shaped, COUNT).select(
        "topic", "partition", "batch_id", "header_key", "offset", "run_no", "bundle_no"
    )


def _bundle_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", "partition", "batch_id", "header_key", "matched", "route", "offset_begin", "offset_end",
        epoch_millis(F.col("timestamp_begin")).alias("begin_ms"), epoch_millis(F.col("timestamp_end")).alias("end_ms"),
        "record_count", "record_size", "mime_type", "content",
    )


def bundle_full(spark: SparkSession, sf: str) -> DataFrame:
    return _bundle_columns(bundle_records(records(spark, sf), TENANT, POLL, "\n", COUNT, SIZE))


def bundle_count_only(spark: SparkSession, sf: str) -> DataFrame:
    return _bundle_columns(bundle_records(records(spark, sf), TENANT, POLL, "\n", COUNT, None))


def offsets_next(spark: SparkSession, sf: str) -> DataFrame:
    return next_offsets(records(spark, sf))


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The same bundles through Structured Streaming: landed files, micro-batches, checkpoint."""
    landed = work_folder(spark, "landed")
    land_records(records(spark, sf), landed, POLL)
    out = ingest(
        spark.readStream.schema(records(spark, sf).schema).option("maxFilesPerTrigger", 4).parquet(landed),
        work_folder(spark, "bundles"), TENANT, POLL, "\n", COUNT, SIZE,
    )
    return _bundle_columns(out)


# At most so many records of a topic-partition in a micro-batch.
STEP = 300


def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """The same bundles from a stream that stops after one bounded micro-batch and goes on from its stored positions."""
    log, target, source = work_folder(spark, "log"), work_folder(spark, "bundles"), records(spark, sf)
    land_log(source, log, POLL)
    rule = (TENANT, POLL, "\n", COUNT, SIZE)
    common = {"max_records": STEP, "reset": "earliest", "schema": source.schema}
    resume_landed(spark, log, target, *rule, trigger={"availableNow": True}, **common).awaitTermination()
    # None: every topic-partition must have a position by now.
    drain(resume_landed(spark, log, target, *rule, trigger={"processingTime": "0 seconds"}, **(common | {"reset": "none"})))
    return _bundle_columns(written_rows(spark, target))


def duration_parse(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = (
        F.when(key % 10 == 0, F.concat(size, F.lit(" secs")))
        .when(key % 10 == 1, F.concat(size, F.lit("min")))
        .when(key % 10 == 2, F.concat(size, F.lit(" Hours")))
        .when(key % 10 == 3, size)
        .when(key % 10 == 4, F.concat(size, F.lit("000000 nanos")))
        .when(key % 10 == 5, F.concat(size, F.lit(" fortnights")))
        .when(key % 10 == 6, F.concat(F.lit("  "), size, F.lit("00 ms ")))
        .when(key % 10 == 7, F.concat(size, F.lit(" wks")))
        .when(key % 10 == 8, F.concat(F.lit("-"), size, F.lit(" s")))
    )
    ms = duration_millis(text)
    return table(spark, sf, "part").select(key, ms.alias("millis"), whole_seconds(ms).alias("seconds"))


QUERIES = {
    f.__name__: f
    for f in (
        record_topics_exact, record_topics_pattern, record_topic_listing, record_from_offset, record_batches,
        record_envelope, record_text_keys, record_json_forms, record_headers, record_direct, record_routes, bundle_runs, bundle_full,
        bundle_count_only, stream_replay, stream_resume, duration_parse,
    )
} | {"next_offsets": offsets_next}

_SHAPED = f"""
{RECORDS_SQL},
shaped AS (
  SELECT topic, partition, "offset", ts_ms, "offset" // {POLL} AS batch_id,
         CASE WHEN tenant IS NULL THEN '{{}}' ELSE '{{"tenant":"' || tenant || '"}}' END AS header_key,
         tenant, ("offset" % 6 <> 0) AS matched,
         '{{' || concat_ws(',', '"key":' || CAST(json(key) AS VARCHAR), '"value":' || CAST(json(value) AS VARCHAR))
             || '}}' AS content
  FROM records
)"""
_KEY = "topic, partition, batch_id, header_key"
_RUNS = f"""
changes AS (
  SELECT *, coalesce(CAST(lag(matched) OVER (PARTITION BY {_KEY} ORDER BY "offset") <> matched AS INTEGER), 0) AS c
  FROM shaped
), runs AS (
  SELECT *, CAST(sum(c) OVER (PARTITION BY {_KEY} ORDER BY "offset") AS BIGINT) AS run_no FROM changes
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY {_KEY}, run_no ORDER BY "offset") - 1 AS place FROM runs
), numbered AS (
  SELECT *, CAST(sum(CASE WHEN place % {COUNT} = 0 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY {_KEY} ORDER BY "offset") AS BIGINT) - 1 AS bundle_no
  FROM placed
)"""
_BUNDLE = f"""
SELECT {_KEY}, bool_and(matched) AS matched,
       CASE WHEN bool_and(matched) THEN 'match' ELSE 'mismatch' END AS route,
       min("offset") AS offset_begin, max("offset") AS offset_end,
       arg_min(ts_ms, "offset") AS begin_ms, arg_max(ts_ms, "offset") AS end_ms,
       count(*) AS record_count, CAST(sum(strlen(content)) + count(*) - 1 AS BIGINT) AS record_size,
       'application/json' AS mime_type, string_agg(content, chr(10) ORDER BY "offset") AS content"""
_BUNDLE_FULL = f"""
WITH RECURSIVE {_SHAPED}, sized AS (
  SELECT *, strlen(content) AS bytes, row_number() OVER (PARTITION BY {_KEY} ORDER BY "offset") AS rn FROM shaped
), walk AS (
  SELECT {_KEY}, rn, matched, 1 AS held, bytes AS size, 1 AS bundle_no, "offset", ts_ms, content FROM sized WHERE rn = 1
  UNION ALL
  SELECT n.topic, n.partition, n.batch_id, n.header_key, n.rn, n.matched,
         CASE WHEN n.matched <> w.matched OR w.held >= {COUNT} OR w.size + 1 + n.bytes > {SIZE}
              THEN 1 ELSE w.held + 1 END,
         CASE WHEN n.matched <> w.matched OR w.held >= {COUNT} OR w.size + 1 + n.bytes > {SIZE}
              THEN n.bytes ELSE w.size + 1 + n.bytes END,
         CASE WHEN n.matched <> w.matched OR w.held >= {COUNT} OR w.size + 1 + n.bytes > {SIZE}
              THEN w.bundle_no + 1 ELSE w.bundle_no END,
         n."offset", n.ts_ms, n.content
  FROM walk w JOIN sized n ON n.topic = w.topic AND n.partition = w.partition AND n.batch_id = w.batch_id
       AND n.header_key = w.header_key AND n.rn = w.rn + 1
)
{_BUNDLE} FROM walk GROUP BY {_KEY}, bundle_no"""

SQL = {
    "record_topics_exact": f"""WITH {RECORDS_SQL} SELECT topic, partition, "offset", key, value, ts_ms FROM records
        WHERE topic IN ('ev.click', 'ev.view', 'ev.vie')""",
    "record_topics_pattern": f"""WITH {RECORDS_SQL} SELECT topic, partition, "offset", key, value, ts_ms FROM records
        WHERE regexp_full_match(topic, 'ev\\.(purchase|sign.*)')""",
    "record_topic_listing": """SELECT event_id, event_type || '|' ||
          array_to_string(list_transform(range(1, user_id % 200 + 2), lambda i: 't' || i), '|') || '|' || user_id AS names,
          CAST(user_id % 200 + 3 AS INTEGER) AS n FROM events""",
    "record_from_offset": f"""WITH {RECORDS_SQL}, committed AS (
          SELECT topic, partition, (max("offset") + 1) // 2 AS next_offset FROM records WHERE partition <> 3
          GROUP BY topic, partition)
        SELECT 'earliest' AS reset, topic, partition, "offset" FROM records LEFT JOIN committed USING (topic, partition)
        WHERE next_offset IS NULL OR "offset" >= next_offset
        UNION ALL
        SELECT 'latest' AS reset, topic, partition, "offset" FROM records JOIN committed USING (topic, partition)
        WHERE "offset" >= next_offset""",
    "record_batches": f"""WITH {RECORDS_SQL} SELECT topic, partition, "offset" // {POLL} AS batch_id,
        count(*) AS record_count FROM records GROUP BY ALL""",
    "record_text_keys": f"""WITH {RECORDS_SQL} SELECT topic, partition, "offset", CAST(to_json(key) AS VARCHAR) AS key_text,
        '{{' || concat_ws(',', '"key":' || CAST(to_json(key) AS VARCHAR), '"value":' || CAST(json(value) AS VARCHAR)) || '}}' AS content
        FROM records""",
    "record_envelope": f"""WITH {_SHAPED} SELECT topic, partition, "offset", content, false AS malformed FROM shaped""",
    "record_json_forms": """SELECT c_custkey, CASE c_custkey % 10
          WHEN 0 THEN '{"id":' || c_custkey || ',"tags":[1,"x",null]}'
          WHEN 1 THEN '"' || c_name || '\\"q"'
          WHEN 2 THEN 'null'
          WHEN 4 THEN '{"id":0,"b":{"x":' || c_custkey || '}}'
          WHEN 5 THEN '[true,' || c_custkey || '.5]'
          WHEN 7 THEN '{"id":' || c_custkey || '}' END AS json FROM customer""",
    "record_headers": f"""WITH {RECORDS_SQL}
        SELECT 'tenant' AS selection, "offset", coalesce('tenant=' || tenant, '') AS headers FROM records UNION ALL
        SELECT 'all', "offset", coalesce('tenant=' || tenant || ';trace=' || trace, '') FROM records UNION ALL
        SELECT 'none', "offset", '' FROM records""",
    "record_direct": f"""WITH {_SHAPED} SELECT topic, partition, "offset", ts_ms, matched,
        CASE WHEN matched THEN 'match' ELSE 'mismatch' END AS route, false AS bundled, 1 AS record_count,
        strlen(content) AS record_size, 'application/json' AS mime_type,
        'PLAINTEXT://{BROKERS}/' || topic AS origin, coalesce('tenant=' || tenant, '') AS headers, content
        FROM shaped""",
    "record_routes": f"""WITH {_SHAPED} SELECT topic, partition,
        CASE WHEN matched THEN 'match' ELSE 'mismatch' END AS route, count(*) AS n,
        CAST(sum("offset") AS BIGINT) AS offset_sum FROM shaped GROUP BY ALL""",
    "bundle_runs": f"""WITH {_SHAPED}, {_RUNS}
        SELECT topic, partition, batch_id, header_key, "offset", run_no, bundle_no FROM numbered""",
    "bundle_full": _BUNDLE_FULL,
    "bundle_count_only": f"""WITH {_SHAPED}, {_RUNS} {_BUNDLE} FROM numbered GROUP BY {_KEY}, bundle_no""",
    "next_offsets": f"""WITH {RECORDS_SQL} SELECT topic, partition, max("offset") + 1 AS next_offset FROM records
        GROUP BY topic, partition""",
    "stream_replay": _BUNDLE_FULL,
    "stream_resume": _BUNDLE_FULL,
    "duration_parse": """SELECT p_partkey, millis, millis // 1000 AS seconds FROM (
        SELECT p_partkey, CAST(CASE p_partkey % 10
          WHEN 0 THEN p_size * 1000 WHEN 1 THEN p_size * 60000 WHEN 2 THEN p_size * 3600000 WHEN 3 THEN p_size
          WHEN 4 THEN p_size WHEN 6 THEN p_size * 100 WHEN 7 THEN CAST(p_size AS BIGINT) * 604800000 END AS BIGINT)
          AS millis FROM part)""",
}
