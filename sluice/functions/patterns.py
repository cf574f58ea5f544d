"""Date and time patterns compiled to column expressions.

A pattern that is known beforehand becomes one regular expression, matched once, and the
wall-clock parts are worked out from its groups. Fields are resolved as
the default patterns are: a day past the end of its month is the last day of that month, 24:00 is the end of the
day, a field that is there twice must be the same, and a name of a day must be that of the date.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.temporal import groups, let, offset_seconds, wall_parts

# English names.
MONTHS = "January February March April May June July August September October November December".split()
DAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()

_TOKENS = re.compile(r"'(?:[^']|'')*'|([A-Za-z])\1*|.", re.S)
# Letters of a number and the least and the largest value it may have.
_NUMBERS = {"M": (1, 12), "L": (1, 12), "d": (1, 31), "D": (1, 366), "H": (0, 23), "k": (1, 24), "K": (0, 11), "h": (1, 12), "m": (0, 59), "s": (0, 59)}
_OFFSETS = {
    "X": {1: r"Z|[+-]\d{2}(?:\d{2})?", 2: r"Z|[+-]\d{4}", 3: r"Z|[+-]\d{2}:\d{2}", 4: r"Z|[+-]\d{4}(?:\d{2})?", 5: r"Z|[+-]\d{2}:\d{2}(?::\d{2})?"},
    "x": {1: r"[+-]\d{2}(?:\d{2})?", 2: r"[+-]\d{4}", 3: r"[+-]\d{2}:\d{2}", 4: r"[+-]\d{4}(?:\d{2})?", 5: r"[+-]\d{2}:\d{2}(?::\d{2})?"},
    "Z": {1: r"[+-]\d{4}", 2: r"[+-]\d{4}", 3: r"[+-]\d{4}", 5: r"Z|[+-]\d{2}:\d{2}(?::\d{2})?"},
}


def _field(letter: str, width: int) -> tuple[str, str] | None:
    """(name of the field, its regular expression) of a run of letters; None for one that is not compiled."""
    if letter in "yu":
        kinds = {1: r"\d{1,9}", 2: r"\d{2}"}
        return ("short_year" if width == 2 else "year"), kinds.get(width, rf"\d{{{width}}}" if width < 10 else "")
    if letter in "ML" and width in (3, 4):
        return "month_name", "|".join(m[:3] if width == 3 else m for m in MONTHS)
    if letter == "E" and width <= 4:
        return "day_name", "|".join(d[:3] if width < 4 else d for d in DAYS)
    if letter == "a" and width == 1:
        return "half", "AM|PM"
    if letter == "S" and width <= 9:
        return "fraction", rf"\d{{{width}}}"
    if letter in _OFFSETS and width in _OFFSETS[letter]:
        return "offset", _OFFSETS[letter][width]
    if letter in _NUMBERS and width <= (3 if letter == "D" else 2):
        most = len(str(_NUMBERS[letter][1]))
        return letter.replace("L", "M"), rf"\d{{1,{most}}}" if width == 1 else rf"\d{{{width}}}"
    return None


def parsed(fmt: str) -> tuple[str, list[str]] | None:
    """The regular expression of a pattern and the field of each of its groups; None for a pattern that is not compiled."""
    out, fields, depth = [], [], 0
    for token in _TOKENS.finditer(fmt):
        text = token.group()
        if text == "[":
            out.append("(?:")
            depth += 1
        elif text == "]":
            if not depth:
                return None
            out.append(")?")
            depth -= 1
        elif text[0] == "'":
            if len(text) < 2 or text[-1] != "'":
                return None
            out.append(re.escape(text[1:-1].replace("''", "'") or "'"))
        elif token.group(1):
            field = _field(token.group(1), len(text))
            if field is None or not field[1]:
                return None
            fields.append(field[0])
            out.append(f"({field[1]})")
        elif text in "{}#":
            return None
        else:
            out.append(re.escape(text))
    # Optional parts may be open at the end.
    return "^" + "".join(out) + ")?" * depth + r"\z", fields


def compiled(fmt: str) -> Callable[[Column], Column] | None:
    """A function from text to its parts; None for a pattern with letters that are not compiled."""
    found = parsed(fmt)
    if found is None or not found[1]:
        return None
    regex, fields = found

    def parts(g: Column) -> Column:
        wrong = F.lit(False)
        values: dict[str, Column] = {}
        for name in dict.fromkeys(fields):
            mine = [F.when(g[i] != "", g[i]) for i, f in enumerate(fields) if f == name]
            values[name] = F.coalesce(*mine)
            for other in mine[1:]:
                wrong = wrong | F.coalesce(_value(name, other) != _value(name, values[name]), F.lit(False))
        given = {n: _value(n, v) for n, v in values.items()}
        for name, v in given.items():
            if name in _NUMBERS:
                # A field of hours may also be 24, at the very end of a day.
                most = 24 if name == "H" else _NUMBERS[name][1]
                wrong = wrong | F.coalesce(~v.between(_NUMBERS[name][0], most), F.lit(False))
        date, bad_date = _date(given)
        day_ms, bad_time = _time(given)
        offset = offset_seconds(values["offset"]) if "offset" in values else None
        if offset is not None:
            wrong = wrong | (values["offset"].isNotNull() & offset.isNull())
        wrong = wrong | bad_date | bad_time
        return F.when(g.isNotNull() & ~wrong, wall_parts(date, day_ms, offset))

    return lambda text: let(groups(text, regex, len(fields)), parts)


def _value(name: str, text: Column) -> Column:
    """A field's number; names count from 1 on, a fraction is milliseconds."""
    if name in ("month_name", "day_name"):
        names = [n[:3] for n in (MONTHS if name == "month_name" else DAYS)]
        place = F.array_position(F.array(*[F.lit(n) for n in names]), F.substring(text, 1, 3)).cast("int")
        return F.when(text.isNotNull(), place)
    if name == "fraction":
        return F.rpad(F.substring(text, 1, 3), 3, "0").cast("int")
    if name == "half":
        return F.when(text == "PM", 1).when(text == "AM", 0)
    if name == "offset":
        return text
    number = text.try_cast("int")
    return number + 2000 if name == "short_year" else number


def _first(given: dict[str, Column], *names: str) -> Column:
    found = [given[n] for n in names if n in given]
    return F.coalesce(*found) if found else F.lit(None).cast("int")


def _first_day(year: Column, month: Column) -> Column:
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-01"))
    return F.when(year.between(1, 9999), text.try_cast("date"))


def _date(given: dict[str, Column]) -> tuple[Column, Column]:
    """The date, and whether the fields contradict each other."""
    year, month, day = _first(given, "year", "short_year"), _first(given, "M", "month_name"), _first(given, "d")
    first = _first_day(year, month)
    clamped = F.least(F.date_add(first, day - 1), F.last_day(first))
    of_year = _first(given, "D")
    start = _first_day(year, F.lit(1))
    counted = F.date_add(start, of_year - 1)
    counted = F.when(F.year(counted) == year, counted)
    date = F.coalesce(F.when(day.isNotNull(), clamped), counted)
    bad = (F.coalesce(of_year.isNotNull(), F.lit(False)) & counted.isNull() & year.isNotNull()) | F.coalesce(clamped != counted, F.lit(False))
    if "M" in given and "month_name" in given:
        bad = bad | F.coalesce(given["M"] != given["month_name"], F.lit(False))
    if "year" in given and "short_year" in given:
        bad = bad | F.coalesce(given["year"] != given["short_year"], F.lit(False))
    if "day_name" in given:
        bad = bad | F.coalesce(F.weekday(date) + 1 != given["day_name"], F.lit(False))
    return date, bad


def _time(given: dict[str, Column]) -> tuple[Column, Column]:
    """Milliseconds of day, and whether the fields contradict each other; without an hour there is no time of day."""
    half = _first(given, "half")
    hours = []
    if "H" in given:
        hours.append(given["H"])
    if "k" in given:
        hours.append(given["k"] % 24)
    for letter in ("h", "K"):
        if letter in given:
            hours.append(half * 12 + given[letter] % 12)
    if not hours:
        return F.lit(None).cast("bigint"), F.lit(False)
    hour, bad = F.coalesce(*hours), F.lit(False)
    for other in hours:
        bad = bad | F.coalesce(other != hour, F.lit(False))
    bad = bad | F.coalesce(half != F.floor(hour / 12), F.lit(False)) & (hour < 24)
    minute, second = (F.coalesce(_first(given, n), F.lit(0)) for n in ("m", "s"))
    rest = minute * 60_000 + second * 1000 + F.coalesce(_first(given, "fraction"), F.lit(0))
    bad = bad | F.coalesce((hour == 24) & (rest > 0), F.lit(False))
    return hour.cast("bigint") * 3_600_000 + rest, bad
