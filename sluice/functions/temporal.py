"""Strict date and time texts: defaults, epoch milliseconds, named formats, patterns.

Everything is read as wall-clock parts (a date, milliseconds of day, an
optional offset); the zone is the session's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
EPOCH_TEXT = r"^-?\d{1,19}$"
# The range of epoch milliseconds that a TIMESTAMP can hold.
EPOCH_LIMIT = 9_223_372_036_854_775

# Named formats and the shapes they take. One letter per part in
# order: c yyyy-MM-dd, b yyyyMMdd, o yyyy-DDD, w yyyy-Www-D, T time of day,
# O offset with colon, B offset without, R [region].
RFC = "RFC_1123_DATE_TIME"
NAMED_SHAPES = {
    "BASIC_ISO_DATE": ["b", "bB"],
    "ISO_LOCAL_DATE": ["c"],
    "ISO_OFFSET_DATE": ["cO"],
    "ISO_DATE": ["c", "cO"],
    "ISO_LOCAL_TIME": ["T"],
    "ISO_OFFSET_TIME": ["TO"],
    "ISO_TIME": ["T", "TO"],
    "ISO_LOCAL_DATE_TIME": ["cT"],
    "ISO_OFFSET_DATE_TIME": ["cTO"],
    "ISO_ZONED_DATE_TIME": ["cTO", "cTOR"],
    "ISO_DATE_TIME": ["cT", "cTO", "cTOR"],
    "ISO_ORDINAL_DATE": ["o", "oO"],
    "ISO_WEEK_DATE": ["w", "wO"],
    "ISO_INSTANT": ["cTZ"],
    RFC: ["r"],
}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_TIME = r"(?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{0,9})?)?"
_ISO = (
    r"(?i)^(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-\d{3}|\d{4}-W\d{2}-[1-7])?"
    rf"(?:(?<=\d)T(?=\d)|^)?({_TIME})?"
    r"(Z|[+-]\d{2}:[0-5]\d(?::[0-5]\d)?|(?<=^\d{8})[+-]\d{4}(?:\d{2})?)?"
    r"(\[[^\]]+\])?$"
)
_RFC = (
    r"(?i)^(?:(mon|tue|wed|thu|fri|sat|sun), )?(\d{1,2}) (jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec) "
    r"(\d{4}) ((?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d)?) (GMT|[+-]\d{4})$"
)
# A pattern Spark's formatter takes: known letters, quoted text, one level of optional parts.
_PART = r"(?:'[^']*'|[yu]{1,6}|[ML]{1,4}|d{1,2}|D{1,3}|[HhKkms]{1,2}|S{1,9}|a|X{1,5}|x{1,5}|z{1,4}|Z{1,5}|VV|OOOO|O|[^A-Za-z'\[\]{}#])"
_PATTERN = rf"^(?:{_PART}|\[{_PART}+\])+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), body)[0]


# Stands between groups; a text that has it matches nothing.
_MARK = "\u0001"


def groups(text: Column, regex: str, count: int) -> Column:
    """ARRAY of the groups 1..count from one match, empty text where a group is absent; NULL if no match."""
    marked = F.regexp_replace(text, regex, _MARK.join(f"${i}" for i in range(1, count + 1)))
    found = F.when(~text.contains(_MARK), F.split(marked, _MARK, -1))
    return let(found, lambda g: F.when(F.size(g) == count, g))


def wall_parts(date: Column, day_ms: Column, offset_s: Column | None = None) -> Column:
    """Wall-clock parts of a text; NULL where absent or invalid."""
    offset_s = F.lit(None) if offset_s is None else offset_s
    return F.struct(
        date.cast("date").alias("date"), day_ms.cast("bigint").alias("day_ms"), offset_s.cast("int").alias("offset_s")
    )


def is_epoch(text: Column, fmt: Column) -> Column:
    """Epoch milliseconds are taken only when no format is given."""
    return is_blank(fmt) & text.rlike(EPOCH_TEXT)


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")


def epoch_timestamp(text: Column) -> Column:
    """Epoch-millisecond text as TIMESTAMP; NULL when a TIMESTAMP cannot hold it."""
    ms = text.try_cast("bigint")
    return F.when(ms.between(-EPOCH_LIMIT, EPOCH_LIMIT), F.timestamp_millis(ms))


def wall_time(epoch_ms: Column, zone: str | Column) -> Column:
    """Epoch milliseconds as wall time in a zone."""
    return F.from_utc_timestamp(F.timestamp_millis(epoch_ms), zone)


def millis_of_day(ts: Column) -> Column:
    """Milliseconds since midnight of a timestamp's wall time."""
    return F.timestamp_diff("MILLISECOND", F.date_trunc("DAY", ts), ts).cast("bigint")


def _day_ms(text: Column) -> Column:
    """Milliseconds of a checked ``HH:mm[:ss[.fraction]]``."""
    seconds = F.rpad(F.substring(text, 7, 2), 2, "0")
    fraction = F.rpad(F.substring(text, 10, 3), 3, "0")
    return (
        F.substring(text, 1, 2).try_cast("bigint") * 3_600_000
        + F.substring(text, 4, 2).try_cast("bigint") * 60_000
        + seconds.try_cast("bigint") * 1000
        + fraction.try_cast("bigint")
    )


def offset_seconds(text: Column) -> Column:
    digits = F.rpad(F.regexp_replace(F.substring(text, 2, 8), ":", ""), 6, "0")
    size = (
        F.substring(digits, 1, 2).try_cast("int") * 3600
        + F.substring(digits, 3, 2).try_cast("int") * 60
        + F.substring(digits, 5, 2).try_cast("int")
    )
    signed = F.when(text.startswith("-"), -size).otherwise(size)
    return F.when(F.upper(text).isin("Z", "GMT"), F.lit(0)).when(F.abs(signed) <= 18 * 3600, signed)


def _week_date(text: Column) -> Column:
    year = F.substring(text, 1, 4)
    week = F.substring(text, 7, 2).try_cast("int")
    monday = F.trunc(F.concat(year, F.lit("-01-04")).try_cast("date"), "WEEK")
    day = F.date_add(monday, (week - 1) * 7 + F.substring(text, 10, 1).try_cast("int") - 1)
    return F.when((F.weekofyear(day) == week) & (week >= 1), day)


def _ordinal_date(text: Column) -> Column:
    first = F.concat(F.substring(text, 1, 4), F.lit("-01-01")).try_cast("date")
    day = F.date_add(first, F.substring(text, 6, 3).try_cast("int") - 1)
    return F.when(F.year(day) == F.year(first), day)


def iso_parts(text: Column, fmt: Column) -> Column:
    """Parts of a text in one of the ISO named formats; all NULL if the shape is another."""
    shapes = F.expr(
        "map(" + ", ".join(f"'{n}', array({', '.join(repr(k) for k in ks)})" for n, ks in NAMED_SHAPES.items()) + ")"
    )
    def body(g: Column) -> Column:
        date, time, offset, region = (g[i] for i in range(4))
        kind = (
            F.when(date == "", "")
            .when(F.length(date) == 8, F.when(date.contains("-"), "o").otherwise("b"))
            .when(date.rlike("(?i)W"), "w")
            .otherwise("c")
        )
        offset_kind = (
            F.when(offset == "", "")
            .when((F.upper(offset) == "Z") & (fmt == "ISO_INSTANT"), "Z")
            .when(offset.contains(":") | ((F.upper(offset) == "Z") & (F.length(date) != 8)), "O")
            .when((F.upper(offset) == "Z") & date.contains("-"), "O")
            .otherwise("B")
        )

        def read(kind: Column) -> Column:
            shape = F.concat(
                kind, F.when(time == "", "").otherwise("T"), offset_kind, F.when(region == "", "").otherwise("R")
            )
            dashed = F.concat_ws("-", F.substring(date, 1, 4), F.substring(date, 5, 2), F.substring(date, 7, 2))
            return F.when(
                F.array_contains(F.try_element_at(shapes, fmt), shape),
                wall_parts(
                    F.when(kind == "c", date.try_cast("date"))
                    .when(kind == "b", dashed.try_cast("date"))
                    .when(kind == "o", _ordinal_date(date))
                    .when(kind == "w", _week_date(date)),
                    F.when(time != "", _day_ms(time)),
                    F.when(offset != "", offset_seconds(offset)),
                ),
            )

        return let(kind, read)

    return let(groups(text, _ISO, 4), body)


def rfc_parts(text: Column) -> Column:
    """Parts of ``[Tue, ]2 Jan 2024 03:04[:05] GMT`` or with ``+0100``."""

    def body(g: Column) -> Column:
        weekday, day, month, year, time, offset = (g[i] for i in range(6))
        number = F.array_position(F.split(F.lit(" ".join(MONTHS)), " "), F.lower(month)).cast("string")
        date = F.concat_ws("-", year, F.lpad(number, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
        right_day = (weekday == "") | (F.lower(F.date_format(date, "EEE")) == F.lower(weekday))
        return F.when(time != "", wall_parts(F.when(right_day, date), _day_ms(time), offset_seconds(offset)))

    return let(groups(text, _RFC, 6), body)


def default_parts(text: Column) -> Column:
    """Parts of ``yyyy-MM-dd``, ``HH:mm:ss.SSS`` or both with a blank between.

    Resolved leniently where the default patterns are: a day past the end of
    its month is the last day, 24:00:00.000 is the end of the day.
    """
    shape = (
        r"^(?:(\d{4})-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]))?(?:(?<=\d) (?=\d))?"
        r"((?:(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d\.\d{3}|24:00:00\.000))?$"
    )

    def body(g: Column) -> Column:
        year, month, day, time = (g[i] for i in range(4))
        first = F.when(year != "0000", F.concat(year, F.lit("-"), month, F.lit("-01")).try_cast("date"))
        date = F.least(F.date_add(first, day.try_cast("int") - 1), F.last_day(first))
        return wall_parts(date, F.when(time != "", _day_ms(time)))

    return let(groups(text, shape, 4), body)


def has_letters(fmt: Column, letters: str) -> Column:
    """Whether a pattern uses any of these letters outside quoted text."""
    return F.regexp_replace(fmt, "'[^']*'", "").rlike(f"[{letters}]")


def is_pattern(fmt: Column) -> Column:
    return fmt.rlike(_PATTERN)


def pattern_parts(text: Column, fmt: Column) -> Column:
    """Parts of a text read with a pattern; what the pattern has no letters for is NULL.

    ``offset_s`` is what leads from the wall time to the instant that Spark
    reads, be it from an offset in the text or from the session zone.
    """

    def body(instant: Column) -> Column:
        # Reached only for texts that are known to parse.
        wall = F.when(instant.isNotNull(), F.to_timestamp_ntz(text, fmt))
        shift = F.timestamp_diff("SECOND", F.expr("timestamp_ntz '1970-01-01'"), wall) - F.unix_seconds(instant)
        return wall_parts(
            F.when(has_letters(fmt, "yuD"), wall.cast("date")),
            F.when(has_letters(fmt, "HhKk"), millis_of_day(wall)),
            shift,
        )

    return let(F.when(is_pattern(fmt), F.try_to_timestamp(text, fmt)), body)


def read_parts(text: Column, fmt: Column | str | None) -> Column:
    """Parts of a text in its format; for a format known beforehand only that reading is built."""
    if isinstance(fmt, Column):
        return (
            F.when(is_blank(fmt), default_parts(text))
            .when(fmt == RFC, rfc_parts(text))
            .when(fmt.isin(list(NAMED_SHAPES)), iso_parts(text, fmt))
            .otherwise(pattern_parts(text, fmt))
        )
    if fmt is None or not fmt.strip():
        return default_parts(text)
    if fmt == RFC:
        return rfc_parts(text)
    if fmt in NAMED_SHAPES:
        return iso_parts(text, F.lit(fmt))
    from sluice.functions.patterns import compiled

    # A pattern that is known beforehand is compiled; one with other letters is left to Spark's formatter.
    read = compiled(fmt)
    return pattern_parts(text, F.lit(fmt)) if read is None else read(text)


def epoch_part(text: Column, fmt: Column | str | None) -> Column:
    """TIMESTAMP of an epoch-millisecond text; NULL when it is none or a format is given."""
    if isinstance(fmt, Column):
        return F.when(is_epoch(text, fmt), epoch_timestamp(text))
    if fmt is None or not fmt.strip():
        return F.when(text.rlike(EPOCH_TEXT), epoch_timestamp(text))
    return F.lit(None).cast("timestamp")


def at(date: Column, day_ms: Column) -> Column:
    """Date and milliseconds of day as wall-clock timestamp."""
    return F.timestamp_add("MILLISECOND", day_ms, date.cast("timestamp_ntz"))
