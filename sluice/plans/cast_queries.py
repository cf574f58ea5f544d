"""Queries of strict conversions, over texts derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import casts as C
from sluice.functions.temporal import wall_time
from sluice.plans.tables import epoch_millis, table

FLAGS = ["1", "t", "T", "true", "TRUE", "0", "yes", ""]
ZONE = "America/New_York"


def _pick(number: Column, values: list) -> Column:
    """The value at place ``number % len``; a Python NULL is a NULL text."""
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        if v is not None:
            hit = number % len(values) == i
            out = F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def cast_flags(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    text = F.when(key % 97 != 0, _pick(key, FLAGS))
    return table(spark, sf, "customer").select(
        key, C.cast_bit(text)["value"].alias("as_bit"), C.cast_boolean(text)["value"].alias("as_boolean")
    )


def cast_numbers(spark: SparkSession, sf: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    text = key.cast("string")
    big = (key * F.lit(1000000007)).cast("string")
    whole = _pick(
        key,
        [text, F.concat(F.lit("+"), text), F.concat(F.lit(" "), text), F.concat(text, F.lit(".5")), "",
         F.concat(F.lit("-"), text), big, "9223372036854775808", None],
    )
    cents = F.round(price * 100).cast("bigint").cast("string")
    number = _pick(
        key,
        [price.cast("string"), F.concat(price.cast("string"), F.lit("x")), F.concat(cents, F.lit("e-2")),
         F.concat(F.lit(" "), cents), F.concat(price.cast("string"), F.lit("00001"))],
    )
    power = F.concat((key % 9 + 1).cast("string"), F.lit("e"), (key % 79 - 39).cast("string"))
    staged = table(spark, sf, "orders").select(key, whole.alias("w"), number.alias("n"), power.alias("p"))
    return staged.select(
        key,
        *[C.cast_integer(F.col("w"), t)["value"].cast("bigint").alias(f"as_{t}") for t in C.INTEGER_TYPES],
        C.cast_integer(F.col("w"), "int")["error"].alias("int_error"),
        C.cast_floating(F.col("n"))["value"].alias("as_double"),
        C.cast_floating(F.col("n"), "float")["value"].cast("double").alias("as_real"),
        C.cast_decimal(F.col("n"), 2)["value"].cast("string").alias("as_decimal"),
        C.decimal_text(F.col("p"))["value"].alias("as_digits"),
    )


def _iso_date(day: Column) -> Column:
    return F.when(day.isNotNull(), F.date_format(day, "yyyy-MM-dd"))


def cast_temporal(spark: SparkSession, sf: str) -> DataFrame:
    """Default formats and epoch milliseconds, with texts that must be refused."""
    ts, event = F.col("ts"), F.col("event_id")
    date, time = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss.SSS")
    text = _pick(
        event,
        [F.concat(date, F.lit(" "), time), epoch_millis(ts).cast("string"), date, time,
         F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.date_format(ts, "yyyy/MM/dd"), None],
    )
    staged = table(spark, sf, "events").select(event, text.alias("t"))
    t = F.col("t")
    as_ts = C.cast_timestamp(t)
    return staged.select(
        event,
        F.unix_millis(as_ts["value"]).alias("ts_ms"),
        as_ts["error"].isNotNull().alias("ts_refused"),
        _iso_date(C.cast_date(t)["value"]).alias("day"),
        C.cast_time(t)["value"].alias("day_ms"),
    )


# Place in this list = event_id modulo its length: named format, and the pattern its text is made with.
NAMED_TEXTS = [
    ("BASIC_ISO_DATE", "yyyyMMdd", ""),
    ("ISO_LOCAL_DATE", "yyyy-MM-dd", ""),
    ("ISO_OFFSET_DATE", "yyyy-MM-dd", "+02:00"),
    ("ISO_DATE", "yyyy-MM-dd", ""),
    ("ISO_LOCAL_TIME", "HH:mm:ss.SSS", ""),
    ("ISO_OFFSET_TIME", "HH:mm:ss", "+02:00"),
    ("ISO_TIME", "HH:mm", ""),
    ("ISO_LOCAL_DATE_TIME", "yyyy-MM-dd'T'HH:mm:ss.SSS", ""),
    ("ISO_OFFSET_DATE_TIME", "yyyy-MM-dd'T'HH:mm:ss.SSS", "-05:30"),
    ("ISO_ZONED_DATE_TIME", "yyyy-MM-dd'T'HH:mm:ss.SSS", "+02:00[Europe/Paris]"),
    ("ISO_DATE_TIME", "yyyy-MM-dd'T'HH:mm:ss.SSS", ""),
    ("ISO_ORDINAL_DATE", "yyyy-DDD", ""),
    ("ISO_WEEK_DATE", None, ""),
    ("ISO_INSTANT", "yyyy-MM-dd'T'HH:mm:ss.SSS", "Z"),
    ("RFC_1123_DATE_TIME", "EEE, d MMM yyyy HH:mm:ss", " GMT"),
    ("dd.MM.yyyy HH'h'mm", "dd.MM.yyyy HH'h'mm", ""),
    ("ISO_LOCAL_DATE", "yyyy/MM/dd", ""),
]


def cast_named_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Every named format, a custom pattern, and a text that has the wrong shape."""
    ts, event = F.col("ts"), F.col("event_id")
    week = F.concat(
        F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"),
        F.lpad(F.weekofyear(ts).cast("string"), 2, "0"), F.lit("-"), (F.weekday(ts) + 1).cast("string"),
    )
    texts = [week if made is None else F.concat(F.date_format(ts, made), F.lit(rest)) for _, made, rest in NAMED_TEXTS]
    staged = table(spark, sf, "events").select(
        event, _pick(event, texts).alias("t"), _pick(event, [name for name, _, _ in NAMED_TEXTS]).alias("f")
    )
    t, f = F.col("t"), F.col("f")
    return staged.select(
        event,
        F.unix_millis(C.cast_timestamp(t, f)["value"]).alias("ts_ms"),
        _iso_date(C.cast_date(t, f)["value"]).alias("day"),
        C.cast_time(t, f)["value"].alias("day_ms"),
    )


# A pattern with optional parts and adjacent fields.
OPTIONAL = "yyyyMMdd'T'HHmm[ss[.SSS]]"


def cast_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Compiled patterns: names of days and months, optional and adjacent parts, halves of a day, days past the end of their month."""
    ts, event = F.col("ts"), F.col("event_id")
    other = F.date_format(F.date_add(ts, 1), "EEE")
    staged = table(spark, sf, "events").select(
        event,
        F.concat(F.when(event % 7 == 0, other).otherwise(F.date_format(ts, "EEE")), F.date_format(ts, " dd.MM.yyyy")).alias("named"),
        _pick(event, [F.date_format(ts, p) for p in ("yyyyMMdd'T'HHmm", "yyyyMMdd'T'HHmmss", "yyyyMMdd'T'HHmmss.SSS", "yyyyMMdd HHmm")]).alias("optional"),
        F.concat(F.lit("31."), F.date_format(ts, "MMMM yy")).alias("clamped"),
        F.date_format(ts, "'at' hh:mm a").alias("half"),
    )
    return staged.select(
        event,
        _iso_date(C.cast_date(F.col("named"), "EEE dd.MM.yyyy")["value"]).alias("named_day"),
        F.unix_millis(C.cast_timestamp(F.col("optional"), OPTIONAL)["value"]).alias("optional_ms"),
        _iso_date(C.cast_date(F.col("clamped"), "d.MMMM yy")["value"]).alias("clamped_day"),
        C.cast_time(F.col("half"), "'at' hh:mm a")["value"].alias("half_ms"),
    )


def cast_binary(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts as bytes in each notation."""
    doc, text = F.col("doc_id"), F.col("text")
    written_as = _pick(doc, [text, text, F.hex(text.cast("binary")), F.base64(text.cast("binary")),
                             F.concat(F.hex(text.cast("binary")), F.lit("A")), text])
    notation = _pick(doc, [None, "ascii", "hex", "base64", "hex", "utf8"])
    staged = table(spark, sf, "documents").select(doc, written_as.alias("t"), notation.alias("f"))
    out = C.cast_binary(F.col("t"), F.col("f"))
    return staged.withColumn("b", out).select(
        doc, F.md5(F.col("b.value")).alias("digest"), F.octet_length("b.value").cast("bigint").alias("n_bytes"),
        F.col("b.error").alias("error"),
    )


def cast_text(spark: SparkSession, sf: str) -> DataFrame:
    value = C.cast_text(F.col("text"))["value"]
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(value.cast("binary")).alias("digest"), F.length(value).cast("bigint").alias("n_chars")
    )


def epoch_zone(spark: SparkSession, sf: str) -> DataFrame:
    wall = wall_time(epoch_millis(F.col("ts")), ZONE)
    return table(spark, sf, "events").select("event_id", F.date_format(wall, "yyyy-MM-dd HH:mm:ss.SSS").alias("wall"))


QUERIES = {
    f.__name__: f
    for f in (cast_flags, cast_numbers, cast_temporal, cast_named_formats, cast_patterns, cast_binary, cast_text, epoch_zone)
}

_FLAG_TEXT = "CASE WHEN c_custkey % 97 <> 0 THEN ['1','t','T','true','TRUE','0','yes',''][c_custkey % 8 + 1] END"
_WHOLE = """CASE o_orderkey % 9 WHEN 0 THEN '' || o_orderkey WHEN 1 THEN '+' || o_orderkey
    WHEN 2 THEN ' ' || o_orderkey WHEN 3 THEN o_orderkey || '.5' WHEN 4 THEN '' WHEN 5 THEN '-' || o_orderkey
    WHEN 6 THEN '' || (o_orderkey * 1000000007) WHEN 7 THEN '9223372036854775808' END"""


def _integer(sql_type: str) -> str:
    return f"CASE WHEN regexp_full_match(w, '[+-]?[0-9]+') THEN CAST(TRY_CAST(w AS {sql_type}) AS BIGINT) END"


_MS = "(epoch_us(ts) // 1000)"
_DAY_MS = f"({_MS} % 86400000)"
SQL = {
    "cast_flags": f"""SELECT c_custkey, lower(v) IN ('1', 't', 'true') AS as_bit, lower(v) = 'true' AS as_boolean
        FROM (SELECT c_custkey, {_FLAG_TEXT} AS v FROM customer)""",
    "cast_numbers": f"""SELECT o_orderkey, {_integer('TINYINT')} AS as_tinyint, {_integer('SMALLINT')} AS as_smallint,
          {_integer('INTEGER')} AS as_int, {_integer('BIGINT')} AS as_bigint,
          CASE WHEN w IS NOT NULL AND ({_integer('INTEGER')}) IS NULL
               THEN '''' || w || ''' is not a valid INTEGER' END AS int_error,
          CASE o_orderkey % 5 WHEN 0 THEN o_totalprice WHEN 2 THEN CAST(cents || 'e-2' AS DOUBLE)
               WHEN 3 THEN CAST(cents AS DOUBLE) WHEN 4 THEN CAST(o_totalprice || '00001' AS DOUBLE) END AS as_double,
          CAST(CASE o_orderkey % 5 WHEN 0 THEN CAST(o_totalprice AS FLOAT) WHEN 2 THEN CAST(cents || 'e-2' AS FLOAT)
               WHEN 3 THEN CAST(cents AS FLOAT) WHEN 4 THEN CAST(o_totalprice || '00001' AS FLOAT) END AS DOUBLE)
            AS as_real,
          CASE WHEN o_orderkey % 5 IN (0, 2) THEN CAST(CAST(o_totalprice AS DECIMAL(38, 2)) AS VARCHAR) END
            AS as_decimal,
          CASE WHEN o_orderkey % 79 BETWEEN 39 AND 76 THEN (o_orderkey % 9 + 1) || repeat('0', o_orderkey % 79 - 39)
               WHEN o_orderkey % 79 BETWEEN 1 AND 38 THEN '0.' || repeat('0', 38 - o_orderkey % 79) || (o_orderkey % 9 + 1) END AS as_digits
        FROM (SELECT o_orderkey, o_totalprice, {_WHOLE} AS w,
                     CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS cents FROM orders)""",
    "cast_temporal": f"""SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN {_MS} END AS ts_ms,
          event_id % 7 IN (2, 3, 4, 5) AS ts_refused,
          CASE WHEN event_id % 7 IN (1, 2) THEN strftime(ts, '%Y-%m-%d') END AS day,
          CASE WHEN event_id % 7 IN (1, 3) THEN {_DAY_MS} END AS day_ms FROM events""",
    "cast_named_formats": f"""SELECT event_id, CASE event_id % 17
            WHEN 7 THEN {_MS} WHEN 8 THEN {_MS} + 19800000 WHEN 9 THEN {_MS} - 7200000 WHEN 10 THEN {_MS}
            WHEN 13 THEN {_MS} WHEN 14 THEN {_MS} // 1000 * 1000 WHEN 15 THEN {_MS} // 60000 * 60000 END AS ts_ms,
          CASE WHEN event_id % 17 NOT IN (4, 5, 6, 16) THEN strftime(ts, '%Y-%m-%d') END AS day,
          CASE WHEN event_id % 17 IN (4, 7, 8, 9, 10, 13) THEN {_DAY_MS}
               WHEN event_id % 17 IN (5, 14) THEN {_DAY_MS} // 1000 * 1000
               WHEN event_id % 17 IN (6, 15) THEN {_DAY_MS} // 60000 * 60000 END AS day_ms FROM events""",
    "cast_patterns": f"""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS named_day,
          CASE event_id % 4 WHEN 0 THEN {_MS} // 60000 * 60000 WHEN 1 THEN {_MS} // 1000 * 1000 WHEN 2 THEN {_MS} END AS optional_ms,
          strftime(last_day(ts), '%Y-%m-%d') AS clamped_day, {_DAY_MS} // 60000 * 60000 AS half_ms FROM events""",
    "cast_binary": """SELECT doc_id, md5(v) AS digest, CAST(strlen(v) AS BIGINT) AS n_bytes,
          CASE doc_id % 6 WHEN 4 THEN 'not a valid hex text' WHEN 5 THEN 'unknown binary format utf8' END AS error
        FROM (SELECT doc_id, CASE WHEN doc_id % 6 IN (0, 1) THEN regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g')
                                  WHEN doc_id % 6 IN (2, 3) THEN text END AS v FROM documents)""",
    "epoch_zone": f"""SELECT event_id, strftime(timezone('{ZONE}', ts AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S.%g') AS wall
        FROM events""",
    "cast_text": """SELECT doc_id, md5(text) AS digest, length(text) AS n_chars FROM documents""",
}
