import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions import casts as C
from sluice.functions.temporal import wall_time


def run_all(spark, cast, rows):
    """(value, error) per (text, format) row; ``cast`` gets both as columns."""
    data = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, t string, f string").repartition(2)
    got = df.select("i", cast(F.col("t"), F.col("f")).alias("r")).orderBy("i").collect()
    return [(r["r"]["value"], r["r"]["error"]) for r in got]


def check(spark, cast, cases):
    """Compare values; a text without a value must come with a reason, another with none."""
    got = run_all(spark, lambda t, f: cast(t), [(text, None) for text, _ in cases])
    assert [v for v, _ in got] == [value for _, value in cases]
    assert [e is None for _, e in got] == [value is not None for _, value in cases]


D, NONE = dt.date, None
DAY = D(2024, 1, 2)


def at(*parts):
    return dt.datetime(2024, 1, 2, *parts)


def test_flags(spark):
    texts = ["1", "t", "T", "true", "TRUE", "TrUe", "0", "f", "yes", "", None]
    rows = [(t, None) for t in texts]
    bits = [True] * 6 + [False] * 4 + [None]
    assert run_all(spark, lambda t, f: C.cast_bit(t), rows) == [(v, None) for v in bits]
    booleans = [False] * 3 + [True] * 3 + [False] * 4 + [None]
    assert run_all(spark, lambda t, f: C.cast_boolean(t), rows) == [(v, None) for v in booleans]


@pytest.mark.parametrize(
    "kind, cases",
    [
        ("tinyint", [("-128", -128), ("128", None), ("+5", 5)]),
        ("smallint", [("+5", 5), ("32768", None)]),
        ("int", [("1", 1), (" 1", None), ("1.5", None), ("", None), ("2147483648", None)]),
        ("bigint", [("9223372036854775807", 2**63 - 1), ("9223372036854775808", None)]),
    ],
)
def test_integers(spark, kind, cases):
    check(spark, lambda t: C.cast_integer(t, kind), cases)
    error = run_all(spark, lambda t, f: C.cast_integer(t, kind), [("x", None)])[0][1]
    assert error == f"'x' is not a valid {C.INTEGER_TYPES[kind]}"


@pytest.mark.parametrize("kind", ["double", "float"])
def test_floating(spark, kind):
    inf = float("inf")
    cases = [("1.5", 1.5), ("1e5", 1e5), ("1d", 1.0), ("0x1p3", 8.0), ("Infinity", inf), ("-Infinity", -inf),
             ("inf", None), ("nan", None), ("x", None), ("", None)]
    check(spark, lambda t: C.cast_floating(t, kind), cases)
    value, error = run_all(spark, lambda t, f: C.cast_floating(t, kind), [("NaN", None)])[0]
    assert value != value and error is None


def test_decimal(spark):
    cases = [("12.50", "12.50"), ("1e5", "100000"), ("1.0050e1", "10.05"), ("-.5", "-0.5"), ("12.", "12"), ("0.000", "0"),
             ("1.005", None), ("1e-3", None), (" 1", None), ("1" * 41, None), ("0x1", None), (".", None), ("1e", None)]
    check(spark, lambda t: C.cast_decimal(t, 2), [(t, None if v is None else Decimal(v)) for t, v in cases])


def test_decimal_digits(spark):
    """Every number that 38 digits hold is taken in either notation, all others are refused."""
    cases = [("1e20", "100000000000000000000"), ("12.5e-20", "0.000000000000000000125"), ("-1e37", "-1" + "0" * 37), ("1e38", None),
             ("1e-38", "0." + "0" * 37 + "1"), ("1e-39", None), ("0e999999999", "0"), ("1e999999999", None), ("9" * 38, "9" * 38), ("9" * 39, None),
             ("0.00e5", "0"), ("1" + "0" * 37, "1" + "0" * 37), ("0" * 50 + "7.50" + "0" * 50, "7.5"), ("1.5", "1.5"), ("+.5", "+.5"),
             ("12\n", None), ("1e", None), ("e5", None), ("", None), ("1.2.3", None), ("\u0661", None), ("-0.0e1", "0")]
    check(spark, C.decimal_text, cases)
    wide = [("1e19", "10000000000000000000"), ("1e20", None), ("1e-18", "0.000000000000000001"), ("1e-19", None), ("0.1e-17", "0.000000000000000001")]
    check(spark, C.cast_decimal, [(t, None if v is None else Decimal(v)) for t, v in wide])


CASES = [
    (C.cast_date, "2024-01-02", NONE, DAY),
    (C.cast_date, "1704153600000", NONE, DAY),
    (C.cast_date, "1704153600000", "  ", DAY),
    (C.cast_date, "2024-02-31", NONE, D(2024, 2, 29)),
    (C.cast_date, "2024-01-02 ", NONE, None),
    (C.cast_date, "2024/01/02", NONE, None),
    (C.cast_date, "2024-01-02 03:04:05.678", NONE, None),
    (C.cast_date, "9223372036854775807", NONE, None),
    (C.cast_date, "", NONE, None),
    (C.cast_date, "20240102", "BASIC_ISO_DATE", DAY),
    (C.cast_date, "20240102+0100", "BASIC_ISO_DATE", DAY),
    (C.cast_date, "2024-002", "ISO_ORDINAL_DATE", DAY),
    (C.cast_date, "2024-W01-2", "ISO_WEEK_DATE", DAY),
    (C.cast_date, "2020-W53-7", "ISO_WEEK_DATE", D(2021, 1, 3)),
    (C.cast_date, "2024-W53-1", "ISO_WEEK_DATE", None),
    (C.cast_date, "2024-02-30", "ISO_LOCAL_DATE", None),
    (C.cast_date, "2024-01-02T23:30:00+02:00", "ISO_OFFSET_DATE_TIME", DAY),
    (C.cast_date, "02.01.2024", "dd.MM.yyyy", DAY),
    (C.cast_date, "2024-01-02", "HH:mm", None),
    (C.cast_date, "x", "{bad", None),
    (C.cast_time, "12:34:56.789", NONE, 45296789),
    (C.cast_time, "45296789", NONE, 45296789),
    (C.cast_time, "-1", NONE, 86399999),
    (C.cast_time, "24:00:00.000", NONE, 0),
    (C.cast_time, "12:34", NONE, None),
    (C.cast_time, "2024-01-02 12:34:56.789", NONE, None),
    (C.cast_time, "12:34", "HH:mm", 45240000),
    (C.cast_time, "12:34:56+01:00", "ISO_OFFSET_TIME", 45296000),
    (C.cast_time, "12:34:56+01:00", "ISO_LOCAL_TIME", None),
    (C.cast_timestamp, "2024-01-02 03:04:05.678", NONE, at(3, 4, 5, 678000)),
    (C.cast_timestamp, "1704164645678", NONE, at(3, 4, 5, 678000)),
    (C.cast_timestamp, "2024-01-02 03:04:05.6", NONE, None),
    (C.cast_timestamp, "2024-01-02", NONE, None),
    (C.cast_timestamp, "2024-01-02T03:04:05+02:00", "ISO_OFFSET_DATE_TIME", at(1, 4, 5)),
    (C.cast_timestamp, "2024-01-02T03:04:05+01:00[Europe/Paris]", "ISO_ZONED_DATE_TIME", at(2, 4, 5)),
    (C.cast_timestamp, "2024-01-02T03:04:05Z", "ISO_INSTANT", at(3, 4, 5)),
    (C.cast_timestamp, "2024-01-02T03:04:05+00:00", "ISO_INSTANT", None),
    (C.cast_timestamp, "2024-01-02T03:04", "ISO_LOCAL_DATE_TIME", at(3, 4)),
    (C.cast_timestamp, "2024-01-02T03:04:05.123456789", "ISO_DATE_TIME", at(3, 4, 5, 123000)),
    (C.cast_timestamp, "2024-01-02T25:04", "ISO_LOCAL_DATE_TIME", None),
    (C.cast_timestamp, "Tue, 2 Jan 2024 03:04:05 GMT", "RFC_1123_DATE_TIME", at(3, 4, 5)),
    (C.cast_timestamp, "2 Jan 2024 03:04 +0100", "RFC_1123_DATE_TIME", at(2, 4)),
    (C.cast_timestamp, "Wed, 2 Jan 2024 03:04:05 GMT", "RFC_1123_DATE_TIME", None),
    (C.cast_timestamp, "2024-01-02 03:04:05+0200", "yyyy-MM-dd HH:mm:ssZ", at(1, 4, 5)),
    (C.cast_timestamp, "2024-01-02", "yyyy-MM-dd", None),
    (C.cast_binary, "hi", NONE, b"hi"),
    (C.cast_binary, "é", "ascii", b"?"),
    (C.cast_binary, "0aFF", "hex", b"\x0a\xff"),
    (C.cast_binary, "ABC", "hex", None),
    (C.cast_binary, "aGk=", "base64", b"hi"),
    (C.cast_binary, "aGk", "base64", None),
    (C.cast_binary, "x", "utf8", None),
]


@pytest.mark.parametrize("cast", [C.cast_date, C.cast_time, C.cast_timestamp, C.cast_binary])
def test_formats(spark, cast):
    mine = [case[1:] for case in CASES if case[0] is cast]
    got = run_all(spark, cast, [(text, fmt) for text, fmt, _ in mine])
    # The same with each format known beforehand.
    df = spark.createDataFrame([tuple(t for t, _, _ in mine)], ", ".join(f"t{i} string" for i in range(len(mine))))
    made = [cast(F.col(f"t{i}"), fmt).alias(f"r{i}") for i, (_, fmt, _) in enumerate(mine)]
    known = [(r["value"], r["error"]) for r in df.repartition(1).select(*made).first()]
    for (text, fmt, value), by_column, by_text in zip(mine, got, known, strict=True):
        assert by_column == by_text, (text, fmt)
        assert by_column[0] == value and (by_column[1] is None) == (value is not None), (text, fmt, by_column)


@pytest.mark.parametrize("cast", [C.cast_date, C.cast_time, C.cast_timestamp, C.cast_binary])
def test_null_is_no_error(spark, cast):
    assert run_all(spark, cast, [(None, None), (None, "ISO_DATE")]) == [(None, None)] * 2


def test_offsets_dropped(spark):
    rows = [("2024-01-02T03:04:05+02:00", "ISO_OFFSET_DATE_TIME"), ("2024-01-02 03:04:05+0200", "yyyy-MM-dd HH:mm:ssZ")]
    assert run_all(spark, lambda t, f: C.cast_timestamp(t, f, "drop"), rows) == [(at(3, 4, 5), None)] * 2


def test_wall_time(spark):
    df = spark.createDataFrame([(1704164645678,)], "ms bigint")
    text = df.select(F.date_format(wall_time(F.col("ms"), "America/New_York"), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    assert text == "2024-01-01 22:04:05.678"


def test_session_zone_rules(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-01-02 03:04:05.678", "45296789")], "t string, e string").repartition(1)
        row = df.select(F.unix_millis(C.cast_timestamp(F.col("t"))["value"]), C.cast_time(F.col("e"))["value"]).first()
        assert tuple(row) == (1704164645678 + 5 * 3600000, 45296789 - 5 * 3600000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_is_whole(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert df.where(C.cast_text(F.col("text"))["value"] != F.col("text")).count() == 0
