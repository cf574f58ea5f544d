"""Strict text-to-type conversion: each cast gives STRUCT<value, error>.

NULL in gives NULL out and no error. A text that does not fit gives NULL and
the reason, never an exception, so one bad row cannot stop a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions import temporal as T

DECIMAL_SCALE = 18


def _checked(text: Column, value: Column, kind: Column | str) -> Column:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    reason = F.concat(F.lit("'"), text, F.lit("' is not a valid "), kind)
    return T.let(
        value, lambda v: F.struct(v.alias("value"), F.when(text.isNotNull() & v.isNull(), reason).alias("error"))
    )


def _free(value: Column) -> Column:
    """A conversion that cannot fail."""
    return F.struct(value.alias("value"), F.lit(None).cast("string").alias("error"))


def cast_bit(text: Column) -> Column:
    """True for ``1``, ``t`` and ``true`` in any case, else false."""
    return _free(F.lower(text).isin("1", "t", "true"))


def cast_boolean(text: Column) -> Column:
    """True only for ``true`` in any case, else false."""
    return _free(F.lower(text) == "true")


# Integer widths by name.
INTEGER_TYPES = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT"}


def cast_integer(text: Column, spark_type: str = "int") -> Column:
    """Sign and digits only, within the range of the type."""
    value = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(spark_type))
    return _checked(text, value, INTEGER_TYPES[spark_type])


def cast_floating(text: Column, spark_type: str = "double") -> Column:
    """Decimal or hexadecimal notation; ``NaN`` and ``Infinity`` in that spelling only."""
    special = text.rlike(r"(?i)^\s*[+-]?(?:inf|infinity|nan)[df]?\s*$")
    value = F.when(~special | text.rlike(r"^\s*[+-]?(?:Infinity|NaN)\s*$"), text.try_cast(spark_type))
    return _checked(text, value, "REAL" if spark_type == "float" else "DOUBLE")


# A number in plain or exponent notation: sign, digits before and after the point, exponent.
_NUMBER = r"^([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]{1,9}))?\z"
MAX_DIGITS = 38


def digits_of(text: Column) -> Column:
    """STRUCT<minus, digits, point>: the number is 0.digits times ten to the power of ``point``; NULL for what is no number.

    ``digits`` has no zeros at its ends, so equal numbers have equal parts; zero has no digits and no sign.
    """

    def parts(p: Column) -> Column:
        kept = F.regexp_replace(p["all"], "^0+", "")
        point = p["before"] - (F.length(p["all"]) - F.length(kept)) + p["power"]
        digits = F.regexp_replace(kept, "0+$", "")
        return F.when(digits == "", _digits(F.lit(False), F.lit(""), F.lit(0))).otherwise(_digits(p["minus"], digits, point))

    def raw(g: Column) -> Column:
        return F.struct(
            (g[0] == "-").alias("minus"), F.concat(g[1], g[2]).alias("all"), F.length(g[1]).alias("before"),
            F.coalesce(g[3].try_cast("int"), F.lit(0)).alias("power"),
        )

    return T.let(T.groups(text, _NUMBER, 4), lambda g: F.when(g.isNotNull(), T.let(raw(g), parts)))


def _digits(minus: Column, digits: Column, point: Column) -> Column:
    return F.struct(minus.alias("minus"), digits.alias("digits"), point.cast("int").alias("point"))


def _places(d: Column) -> tuple[Column, Column]:
    """How many digits plain notation needs before and after the point."""
    whole, decimals = F.greatest(d["point"], F.lit(0)), F.greatest(F.length(d["digits"]) - d["point"], F.lit(0))
    return F.when(d.isNotNull(), whole), F.when(d.isNotNull(), decimals)


def _plain(d: Column) -> Column:
    """The number in plain notation; only for numbers of few digits, as zeros are written out."""
    digits, point, size = d["digits"], d["point"], F.length(d["digits"])
    text = (
        F.when(digits == "", "0")
        .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size)))
        .when(point > 0, F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, size)))
        .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
    )
    return F.concat(F.when(d["minus"], "-").otherwise(""), text)


def cast_decimal(text: Column, scale: int = DECIMAL_SCALE) -> Column:
    """Exact decimal number in either notation; one that DECIMAL(38, scale) would round or cannot hold is an error."""

    def value(d: Column) -> Column:
        whole, decimals = _places(d)
        return F.when((whole <= MAX_DIGITS - scale) & (decimals <= scale), _plain(d).try_cast(f"decimal(38,{scale})"))

    return _checked(text, T.let(digits_of(text), value), "DECIMAL")


def decimal_places(text: Column) -> Column:
    """How many decimals a number in plain or exponent notation needs."""
    return T.let(digits_of(text), lambda d: _places(d)[1])


def decimal_text(text: Column) -> Column:
    """A decimal number as text: any that 38 digits hold, in plain notation, as it was written where it was."""

    def value(d: Column) -> Column:
        whole, decimals = _places(d)
        as_written = text.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z") & (F.length(text) <= MAX_DIGITS + 2)
        return F.when(whole + decimals <= MAX_DIGITS, F.when(as_written, text).otherwise(_plain(d)))

    return _checked(text, T.let(digits_of(text), value), "DECIMAL")


def _no_format(fmt: Column | str | None) -> Column:
    return T.is_blank(fmt) if isinstance(fmt, Column) else F.lit(fmt is None or not fmt.strip())


def date_of(epoch: Column, parts: Column, no_format: Column) -> Column:
    """The date; without a format the text may have no time of day."""
    surplus = no_format & parts["day_ms"].isNotNull()
    return F.coalesce(epoch.cast("date"), F.when(~surplus, parts["date"]))


def time_of(epoch: Column, parts: Column, no_format: Column) -> Column:
    """Milliseconds of day; without a format the text may have no date."""
    surplus = no_format & parts["date"].isNotNull()
    return F.coalesce(T.millis_of_day(epoch), F.when(~surplus, parts["day_ms"] % T.DAY_MS))


def timestamp_of(epoch: Column, parts: Column, honour: bool = True) -> Column:
    """The instant, from wall time and offset, or from wall time in the session zone."""
    local = T.at(parts["date"], parts["day_ms"]).cast("timestamp")
    if honour:
        utc_ms = F.unix_date(parts["date"]).cast("bigint") * T.DAY_MS + parts["day_ms"]
        local = F.coalesce(F.timestamp_millis(utc_ms - parts["offset_s"] * 1000), local)
    return F.coalesce(epoch, local)


def cast_date(text: Column, fmt: Column | str | None = None) -> Column:
    """Date from epoch milliseconds, ``yyyy-MM-dd``, a named format or a pattern."""
    epoch = T.epoch_part(text, fmt)
    return _checked(text, T.let(T.read_parts(text, fmt), lambda p: date_of(epoch, p, _no_format(fmt))), "DATE")


def cast_time(text: Column, fmt: Column | str | None = None) -> Column:
    """Milliseconds of day from epoch milliseconds, ``HH:mm:ss.SSS``, a named format or a pattern."""
    epoch = T.epoch_part(text, fmt)
    return _checked(text, T.let(T.read_parts(text, fmt), lambda p: time_of(epoch, p, _no_format(fmt))), "TIME")


def cast_timestamp(text: Column, fmt: Column | str | None = None, offsets: str = "honour") -> Column:
    """Timestamp from epoch milliseconds, ``yyyy-MM-dd HH:mm:ss.SSS``, a named format or a pattern.

    ``offsets="drop"`` takes the wall time of a text with an offset as it
    stands, in the session zone.
    """
    if offsets not in ("honour", "drop"):
        raise ValueError("offsets must be honour or drop")
    epoch = T.epoch_part(text, fmt)
    value = T.let(T.read_parts(text, fmt), lambda p: timestamp_of(epoch, p, offsets == "honour"))
    return _checked(text, value, "TIMESTAMP")


def cast_temporal_text(text: Column, fmt: Column, code: Column) -> Column:
    """Any of the three by its type code, as text that Spark reads back; the text is read once."""
    epoch, blank = T.epoch_part(text, fmt), T.is_blank(fmt)

    def choose(p: Column) -> Column:
        return (
            F.when(code == 91, date_of(epoch, p, blank).cast("string"))
            .when(code == 92, time_of(epoch, p, blank).cast("string"))
            .otherwise(timestamp_of(epoch, p).cast("string"))
        )

    kind = F.when(code == 91, "DATE").when(code == 92, "TIME").otherwise("TIMESTAMP")
    return _checked(text, T.let(T.read_parts(text, fmt), choose), kind)


def cast_binary(text: Column, fmt: Column | str | None = None) -> Column:
    """Bytes from ascii (default; other characters become ``?``), hex or base64."""
    fmt = fmt if isinstance(fmt, Column) else F.lit(fmt).cast("string")
    compact = F.regexp_replace(text, r"\s", "")
    value = (
        F.when(
            T.is_blank(fmt) | (fmt == "ascii"),
            F.encode(F.regexp_replace(text, r"[^\x00-\x7F]", "?"), "US-ASCII"),
        )
        .when((fmt == "hex") & text.rlike(r"^(?:[0-9A-Fa-f]{2})*$"), F.unhex(text))
        .when(
            (fmt == "base64")
            & compact.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"),
            F.unbase64(compact),
        )
    )
    known = T.is_blank(fmt) | fmt.isin("ascii", "hex", "base64")
    error = F.when(~known, F.concat(F.lit("unknown binary format "), fmt)).when(
        value.isNull(), F.concat(F.lit("not a valid "), fmt, F.lit(" text"))
    )
    return F.struct(value.alias("value"), F.when(text.isNotNull(), error).alias("error"))


def cast_text(text: Column) -> Column:
    """Text types pass through unchanged."""
    return _free(text.cast("string"))
