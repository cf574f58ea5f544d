import datetime

import pytest
from pyspark.sql import functions as F

from sluice.functions.patterns import compiled, parsed
from sluice.functions.temporal import read_parts

D = datetime.date


def ms(h, m=0, s=0, f=0):
    return ((h * 60 + m) * 60 + s) * 1000 + f


CASES = [
    ("EEE dd.MM.yyyy", "Tue 02.01.2024", (D(2024, 1, 2), None, None)),
    ("EEE dd.MM.yyyy", "Wed 02.01.2024", None),
    ("dd.MM.yyyy", "31.02.2024", (D(2024, 2, 29), None, None)),
    ("dd.MM.yyyy", "31.02.2023", (D(2023, 2, 28), None, None)),
    ("dd.MM.yyyy", "32.01.2024", None),
    ("dd.MM.yyyy", "01.13.2024", None),
    ("dd.MM.yyyy", "1.1.2024", None),
    ("d.M.yyyy", "1.1.2024", (D(2024, 1, 1), None, None)),
    ("d MMMM uuuu", "7 March 1999", (D(1999, 3, 7), None, None)),
    ("d MMM yy", "7 Mar 24", (D(2024, 3, 7), None, None)),
    ("d MMM yy", "7 mar 24", None),
    ("yyyyMMddHHmmssSSS", "20240102030405678", (D(2024, 1, 2), ms(3, 4, 5, 678), None)),
    ("yyyy-DDD", "2024-366", (D(2024, 12, 31), None, None)),
    ("yyyy-DDD", "2023-366", None),
    ("yyyy-MM-dd[ HH:mm[:ss]]", "2024-01-02", (D(2024, 1, 2), None, None)),
    ("yyyy-MM-dd[ HH:mm[:ss]]", "2024-01-02 03:04", (D(2024, 1, 2), ms(3, 4), None)),
    ("yyyy-MM-dd[ HH:mm[:ss]]", "2024-01-02 03:04:05", (D(2024, 1, 2), ms(3, 4, 5), None)),
    ("yyyy-MM-dd[ HH:mm[:ss]]", "2024-01-02 03", None),
    ("hh:mm a", "12:30 AM", (None, ms(0, 30), None)),
    ("hh:mm a", "12:30 PM", (None, ms(12, 30), None)),
    ("hh:mm a", "13:30 PM", None),
    ("KK a", "11 PM", (None, ms(23), None)),
    ("kk:mm", "24:05", (None, ms(0, 5), None)),
    ("HH:mm", "24:00", (None, ms(24), None)),
    ("HH:mm", "24:01", None),
    ("HH 'o''clock'", "09 o'clock", (None, ms(9), None)),
    ("HH:mm HH", "09:30 09", (None, ms(9, 30), None)),
    ("HH:mm HH", "09:30 10", None),
    ("HH:mm:ssXXX", "03:04:05+02:00", (None, ms(3, 4, 5), 7200)),
    ("HH:mm:ssX", "03:04:05Z", (None, ms(3, 4, 5), 0)),
    ("HH:mm:ssZ", "03:04:05-0130", (None, ms(3, 4, 5), -5400)),
    ("HH:mm:ssxx", "03:04:05Z", None),
    ("HH:mm.", "03:04x", None),
    ("HH:mm", "03:04\n", None),
    ("yyyy", "2024", (None, None, None)),
    ("mm:ss", "04:05", (None, None, None)),
]


def test_against_expected_parts(spark):
    df = spark.createDataFrame([tuple(t for _, t, _ in CASES)], ", ".join(f"t{i} string" for i in range(len(CASES))))
    row = df.repartition(1).select(*[read_parts(F.col(f"t{i}"), fmt).alias(f"r{i}") for i, (fmt, _, _) in enumerate(CASES)]).first()
    for (fmt, text, expected), got in zip(CASES, row, strict=True):
        assert (got if got is None else tuple(got)) == expected, (fmt, text, got)


@pytest.mark.parametrize("fmt", ["GGG yyyy", "yyyy{", "'open", "yyyy]", "VV", "QQQ", "EEEEE", "no", ""])
def test_what_is_not_compiled(fmt):
    assert compiled(fmt) is None


def test_groups_and_quotes():
    assert parsed("yyyy[-MM")[0] == r"^(\d{4})(?:\-(\d{2}))?\z"
    assert parsed("''HH''")[0] == r"^'(\d{2})'\z"


def test_parts_are_read_once(spark):
    df = spark.createDataFrame([("Tue 02.01.2024",)], "t string").select(read_parts(F.col("t"), "EEE dd.MM.yyyy").alias("r"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
