"""Duration texts such as ``5 secs``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit spellings and their length in nanoseconds.
UNIT_NANOS = {
    **dict.fromkeys(("ns", "nano", "nanos", "nanosecond", "nanoseconds"), 1),
    **dict.fromkeys(("ms", "milli", "millis", "millisecond", "milliseconds"), 10**6),
    **dict.fromkeys(("s", "sec", "secs", "second", "seconds"), 10**9),
    **dict.fromkeys(("m", "min", "mins", "minute", "minutes"), 60 * 10**9),
    **dict.fromkeys(("h", "hr", "hrs", "hour", "hours"), 3600 * 10**9),
    **dict.fromkeys(("d", "day", "days"), 86400 * 10**9),
    **dict.fromkeys(("w", "wk", "wks", "week", "weeks"), 7 * 86400 * 10**9),
}
_SHAPE = r"^([0-9]+)(?:\s*([a-z]+))?$"


def duration_millis(text: Column) -> Column:
    """Milliseconds as BIGINT: a bare number as is, else number and unit; NULL if neither."""
    clean = F.lower(F.trim(text))
    number = F.regexp_extract(clean, _SHAPE, 1).try_cast("decimal(19,0)")
    unit = F.regexp_extract(clean, _SHAPE, 2)
    nanos = F.create_map(*[F.lit(x) for pair in UNIT_NANOS.items() for x in pair])
    per_unit = F.when(unit == "", F.lit(10**6)).otherwise(F.try_element_at(nanos, unit))
    millis = (per_unit / F.lit(10**6)).cast("decimal(10,0)")
    return F.when(per_unit >= 10**6, (number * millis).try_cast("bigint")).when(
        per_unit == 1, F.floor(number.try_cast("bigint") / F.lit(10**6))
    )


def whole_seconds(millis: Column) -> Column:
    """Statement time limit: whole seconds, below one second means no limit (0)."""
    return F.floor(millis / F.lit(1000)).cast("bigint")


def parse_millis(text: str) -> int:
    """The same rule for one configuration value on the driver."""
    found = re.match(_SHAPE, text.strip().lower())
    unit = found and found.group(2)
    if not found or (unit and unit not in UNIT_NANOS):
        raise ValueError(f"not a duration: {text!r}")
    return int(found.group(1)) * UNIT_NANOS[unit or "ms"] // 10**6
