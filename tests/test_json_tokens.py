import json
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.json_text import canonical_json
from sluice.functions.json_tokens import compact_json, java_double

values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text(alphabet=st.characters(exclude_categories=["Cs"])),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=5, alphabet=st.characters(exclude_categories=["Cs"])), inner, max_size=4),
    max_leaves=30,
)


@given(values, st.sampled_from([None, 2]), st.booleans())
@settings(max_examples=300, deadline=None)
def test_same_values_in_compact_form(value, indent, ascii_only):
    found = compact_json(json.dumps(value, indent=indent, ensure_ascii=ascii_only) + " rest")
    assert json.loads(found) == value
    if "\\u" not in found:
        assert found == json.dumps(value, ensure_ascii=False, separators=(",", ":"))


@pytest.mark.parametrize(
    "text",
    ["", " ", "{", "[1,", "[1 2]", '{"a" 1}', "{'a':1}", '{"a":1,}', "[1,]", "nul", "NaN", "01x"[2:], "-", '"a\nb"', '"\\x"', '"\\ud800"', "]", '{"a":}', "{1:2}", '"'],
)
def test_what_is_no_json(text):
    with pytest.raises(ValueError):
        compact_json(text)


def test_equal_names_and_numbers():
    assert compact_json('{ "a":1, "b":{"x":1,"x":[ ]}, "a" : 1.50 , "\\u0061": 2E3} tail') == '{"a":2000.0,"b":{"x":[]}}'
    assert compact_json('["\\u001f\\/\\u00e9", -0, 12345678901234567890, 1e400]') == '["\\u001f/é",0,12345678901234567890,1e400]'
    # As the JVM writes doubles.
    cases = {1e7: "1.0E7", 0.001: "0.001", 9999999.5: "9999999.5", 1.5e-4: "1.5E-4", -1e300: "-1.0E300", 100.0: "100.0", -0.0: "-0.0", 0.5: "0.5"}
    assert {x: java_double(x) for x in cases} == cases


def test_beyond_the_limits_of_the_parsers(spark):
    """Long strings, long texts and deep nesting are read; equal names in them too."""
    deep = "[" * 1200 + '{"a":1, "a" : 2}' + "]" * 1200
    very_deep = '{"n":' * 200_000 + "1.50" + "}" * 200_000
    long = '{"a": "' + "x" * 25_000_000 + '", "b" :1}'
    broken = "[" * 1200 + "1" + "]" * 1199
    start = time.monotonic()
    df = spark.createDataFrame([(1, deep), (2, very_deep), (3, long), (4, broken), (5, '{"a":1,"a":1.50}')], "i int, t string")
    got = {r["i"]: r["j"] for r in df.select("i", canonical_json(F.col("t")).alias("j")).collect()}
    assert got[1] == "[" * 1200 + '{"a":2}' + "]" * 1200
    assert got[2] == '{"n":' * 200_000 + "1.5" + "}" * 200_000
    assert got[3] == '{"a":"' + "x" * 25_000_000 + '","b":1}'
    assert got[4] is None and got[5] == '{"a":1.5}'
    assert time.monotonic() - start < 120
