import json
import random
import time
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluice.operators.calls import (
    Count,
    Insert,
    Procedure,
    Rows,
    bind_requests,
    document_places,
    result_pieces,
    row_json,
    run_by_statement,
    run_calls,
    run_statement,
    run_statements,
    single_request,
)
from sluice.operators.parameters import Argument, direction, parameter_rows, with_parameters
from sluice.operators.statements import for_all_calls, with_columns
from sluice.operators.writes import WrittenTable
from sluice.session import delete_folder

P = "procedure.args"


def requests(spark, *attributes):
    return spark.createDataFrame(list(enumerate(attributes)), "request_id bigint, attributes map<string,string>").repartition(2)


def listed(spark, attributes, properties=None):
    rows = parameter_rows(with_parameters(requests(spark, attributes), properties)).orderBy("index").collect()
    return [(r["index"], r["direction"], r["type_name"], r["value"], r["format"], r["name"], r["error"]) for r in rows]


def test_parameters_from_attributes(spark):
    got = listed(
        spark,
        {
            f"{P}.in.1.type": "12", f"{P}.in.1.value": "a", f"{P}.in.1.name": "ignored",
            f"{P}.out.2.type": "4", f"{P}.out.2.name": "N", f"{P}.out.2.value": "ignored",
            f"{P}.inout.03.type": "91", f"{P}.inout.3.value": "v", f"{P}.inout.03.format": "f", f"{P}.inout.3.name": " ",
            f"{P}.IN.4.type": "12", f"{P}.in.5.value": "no type", "other": "x", f"{P}.in.6.type ": "12",
        },
    )
    assert got == [
        (1, "in", "VARCHAR", "a", None, None, None),
        (2, "out", "INTEGER", None, None, "N", None),
        (3, "inout", "DATE", "v", "f", None, None),
    ]


def test_request_overrides_property(spark):
    properties = {
        f"{P}.in.1.type": "12", f"{P}.in.1.value": "p", f"{P}.in.1.format": "pf",
        f"{P}.out.2.type": "4", f"{P}.out.2.name": "P", f"{P}.in.3.type": "4", f"{P}.in.3.value": "3",
    }
    got = listed(
        spark,
        {
            f"{P}.in.1.type": "1", f"{P}.in.1.value": "r", f"{P}.out.2.type": "5", f"{P}.out.2.name": "  ",
            f"{P}.in.3.value": "9", f"{P}.inout.4.type": "8",
        },
        properties,
    )
    assert got == [
        (1, "in", "CHAR", "r", "pf", None, None),
        (2, "out", "SMALLINT", None, None, "P", None),
        (3, "in", "INTEGER", "3", None, None, None),
        (4, "inout", "DOUBLE", None, None, None, None),
    ]
    # A changed direction keeps the property's value.
    assert listed(spark, {f"{P}.inout.1.type": "12"}, properties)[0] == (1, "inout", "VARCHAR", "p", "pf", None, None)


def test_bad_types_are_reported(spark):
    got = listed(spark, {f"{P}.in.1.type": "x", f"{P}.in.2.type": "777", f"{P}.in.99999999999.type": "4"})
    assert [g[-1] for g in got] == [
        f"bad index in {P}.in.99999999999.type", "type is not a number: x", "unknown type code 777",
    ]


def test_direction(spark):
    df = spark.createDataFrame([("In",), ("OUT",), ("inOut",), ("both",), (None,)], "d string")
    assert [r[0] for r in df.select(direction(F.col("d"))).collect()] == ["in", "out", "inout", None, None]


SIMPLE = Procedure(
    [Argument(1, "p1", "string"), Argument(2, "p2", "double"), Argument(4, "p4", "bigint", False)],
    [],
    {3: lambda df: F.length("p1"), 4: lambda df: F.col("p4") + 1},
)
GOOD = {f"{P}.in.1.type": "12", f"{P}.in.1.value": "a", f"{P}.in.2.type": "8", f"{P}.in.2.value": "0"}


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({f"{P}.in.2.type": "4", f"{P}.in.2.value": "x"}, "parameter 2: 'x' is not a valid INTEGER"),
        ({f"{P}.in.4.type": "91", f"{P}.in.4.value": "2024-01-01"}, "parameter 4: '2024-01-01' cannot be used as bigint"),
        ({f"{P}.in.4.type": "4"}, None),
        ({f"{P}.in.4.type": "8", f"{P}.in.4.value": "1.5"}, "parameter 4: '1.5' cannot be used as bigint"),
        ({f"{P}.in.9.type": "12"}, "parameter 9: no such parameter"),
        ({f"{P}.out.1.type": "12"}, "parameter 1: is not an output"),
        ({f"{P}.in.3.type": "12"}, "parameter 3: is not an input"),
        ({f"{P}.in.2.type": "-2", f"{P}.in.2.value": "zz", f"{P}.in.2.format": "hex"}, "parameter 2: not a valid hex text"),
        ({f"{P}.in.99999999999.type": "4"}, f"parameter ?: bad index in {P}.in.99999999999.type"),
    ],
)
def test_binding(spark, change, reason):
    assert bind_requests(requests(spark, GOOD | change), SIMPLE).first()["error"] == reason


def test_missing_argument(spark):
    assert bind_requests(requests(spark, {}), SIMPLE).first()["error"] == "parameter 1: is not given"


@pytest.mark.parametrize(
    "spark_type, code, value, fmt, expected",
    [
        ("binary", "-3", "0aFF", "hex", b"\x0a\xff"),
        ("binary", "12", "hi", None, b"hi"),
        ("bigint", "92", "00:00:01.500", None, 1500),
        ("boolean", "-7", "t", None, True),
        ("int", "3", "12.00", None, 12),
        ("int", "8", "1e3", None, 1000),
        ("string", "2005", "é\n", None, "é\n"),
        ("date", "93", "1704164645678", None, __import__("datetime").date(2024, 1, 2)),
    ],
)
def test_types_of_arguments(spark, spark_type, code, value, fmt, expected):
    attributes = {f"{P}.in.1.type": code, f"{P}.in.1.value": value} | ({f"{P}.in.1.format": fmt} if fmt else {})
    row = bind_requests(requests(spark, attributes), Procedure([Argument(1, "x", spark_type)])).first()
    assert (row["x"], row["error"]) == (expected, None)


@pytest.mark.parametrize(
    "spark_type, code, value, expected",
    [
        ("decimal(10,2)", "3", "1.005", None), ("decimal(10,2)", "3", "1.50", Decimal("1.50")),
        ("decimal(38,0)", "3", "1" * 38, Decimal("1" * 38)), ("decimal(38,1)", "2", "1" * 21 + ".5", Decimal("1" * 21 + ".5")),
        ("decimal(38,20)", "2", "0.1234567890123456789", Decimal("0.1234567890123456789")), ("decimal(10,0)", "3", "1.2e1", Decimal(12)),
        ("decimal(10,0)", "3", "1e-1", None), ("decimal(4,0)", "3", "12345", None), ("string", "3", "12.50", "12.50"),
        ("double", "3", "9007199254740993", None), ("double", "3", "9007199254740992", 9007199254740992.0),
        ("double", "3", "12345678901234567890123", None), ("float", "3", "12345678901234567890123", None),
        ("double", "3", "7" + "0" * 24, 7e24), ("float", "3", "7" + "0" * 24, 6.999999808708619e24), ("double", "3", "1e-30", 1e-30),
        ("double", "3", "1" + "0" * 23, 1e23), ("float", "3", "1e-37", 9.99999991097579e-38), ("double", "3", "1.00000000000000000001", None),
        ("bigint", "3", "7" + "0" * 24, None), ("bigint", "3", "9223372036854775807", 9223372036854775807), ("bigint", "3", "1.2e3", 1200),
        ("decimal(38,0)", "3", "1e37", Decimal(10**37)), ("decimal(38,30)", "3", "1e-30", Decimal("1e-30")), ("decimal(38,18)", "3", "1e25", None),
        ("double", "3", "9007199254740993", None), ("double", "3", "1" + "0" * 22 + "1", None),
        ("double", "8", "0.1", 0.1), ("float", "8", "0.5", 0.5), ("float", "8", "1e300", None), ("double", "8", "1e300", 1e300),
    ],
)
def test_no_value_is_changed(spark, spark_type, code, value, expected):
    attributes = {f"{P}.in.1.type": code, f"{P}.in.1.value": value}
    row = bind_requests(requests(spark, attributes), Procedure([Argument(1, "x", spark_type)])).first()
    assert row["x"] == expected and (row["error"] is None) == (expected is not None)


def test_whole_call(spark):
    """Readings of a sensor over a limit, the stations near it, and how many readings there are."""
    tables = {
        "readings": spark.createDataFrame([(7, 3, 1.5), (7, 1, 9.25), (7, 2, None), (8, 1, 4.0)], "sensor int, hour int, level double"),
        "stations": spark.createDataFrame([("north", 7), ("east", 7), ("south", 9)], "station string, sensor int"),
    }

    def stations(calls, t):
        return calls.join(t["stations"], calls["p2"] == t["stations"]["sensor"]).select("request_id", "station")

    procedure = Procedure(
        [Argument(1, "p1", "double"), Argument(2, "p2", "int")],
        [
            Rows("SELECT request_id, hour, level FROM {calls} JOIN {readings} r ON r.sensor = p2 AND NOT level <= p1 IS TRUE", ["hour"]),
            Rows(stations, ["station"]),
            Count("SELECT request_id FROM {calls} JOIN {readings} r ON r.sensor = p2"),
        ],
        {3: lambda df: F.col("rows_3") * 10, 4: lambda df: F.concat(F.lit("s"), F.col("p2").cast("string"))},
    )
    properties = {
        f"{P}.in.1.type": "8", f"{P}.in.1.value": "2", f"{P}.in.2.type": "5", f"{P}.in.2.value": "7",
        f"{P}.out.3.type": "-5", f"{P}.out.3.name": "SCORE", f"{P}.out.4.type": "12",
    }
    done = run_calls(single_request(spark), procedure, tables, properties)
    text = (
        '{"RESULTS":[[{"hour":1,"level":9.25},{"hour":2,"level":null}],[{"station":"east"},{"station":"north"}],3],'
        '"OUTPUTS":{"SCORE":30,"output_4":"s7"}}'
    )
    assert [tuple(r) for r in done.contents.collect()] == [(0, 0, text)]
    row = done.calls.first()
    assert (row["route"], row["error"], row["pieces"], row["bytes"]) == ("success", None, 1, len(text))
    assert row["duration_ms"] >= 0


def test_time_limit(spark):
    @F.pandas_udf("long")
    def slow(ids: pd.Series) -> pd.Series:
        time.sleep(30)
        return ids

    procedure = Procedure(SIMPLE.arguments, [Rows(lambda calls, t: calls.select("request_id", slow("request_id").alias("n")))], SIMPLE.outputs)
    started = time.monotonic()
    done = run_calls(requests(spark, GOOD, GOOD | {f"{P}.in.2.value": "x"}), procedure, {}, limit_millis=1500)
    rows = {r["request_id"]: r for r in done.calls.collect()}
    assert time.monotonic() - started < 25 and done.contents.isEmpty()
    assert rows[0]["error"] == "time limit of 1500 ms exceeded" and rows[0]["route"] == "failure" and rows[0]["duration_ms"] is None
    assert rows[1]["error"] == "parameter 2: 'x' is not a valid DOUBLE"
    # The limit is for its own jobs only, and one that is long enough changes nothing.
    assert run_calls(requests(spark, GOOD), SIMPLE, {}, limit_millis=600_000).calls.first()["route"] == "success"


def test_nothing_is_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    run_calls(requests(spark, GOOD), SIMPLE, {})
    assert {t.name for t in spark.catalog.listTables()} == before


EMPTY = Rows("SELECT request_id, p1 FROM {calls} WHERE false")


@pytest.mark.parametrize(
    "steps, output, expected",
    [
        ([], None, "{}"),
        ([], f"{P}.out.3.type", '{"OUTPUTS":{"output_3":1}}'),
        ([EMPTY, EMPTY], None, '{"RESULTS":[]}'),
        ([EMPTY, Count("SELECT request_id FROM {calls} WHERE false")], None, '{"RESULTS":[0]}'),
        ([Count("SELECT request_id FROM {calls}"), EMPTY, Count("SELECT request_id FROM {calls}")], None, '{"RESULTS":[1,1]}'),
    ],
)
def test_document_shapes(spark, steps, output, expected):
    attributes = GOOD | ({output: "4"} if output else {})
    done = run_calls(requests(spark, attributes), Procedure(SIMPLE.arguments, steps, SIMPLE.outputs), {})
    assert [r["content"] for r in done.contents.collect()] == [expected]


def test_failures_keep_the_request(spark):
    bad = GOOD | {f"{P}.in.2.value": "x", "keep": "me"}
    done = run_calls(requests(spark, GOOD, bad), SIMPLE, {})
    rows = {r["request_id"]: r for r in done.calls.collect()}
    assert rows[0]["route"] == "success" and rows[0]["attributes"] == GOOD
    assert rows[1]["route"] == "failure" and rows[1]["attributes"] == bad and rows[1]["pieces"] == 0
    assert [r["request_id"] for r in done.contents.collect()] == [0] and rows[1]["duration_ms"] is None
    assert rows[1]["error"] == "parameter 2: 'x' is not a valid DOUBLE"


def test_statement_chooses_the_procedure(spark):
    name = "stored.procedure.statement"
    reqs = requests(spark, GOOD | {name: "simple"}, GOOD | {name: " "}, GOOD, GOOD | {name: "other"})
    rows = {r["request_id"]: r["error"] for r in run_by_statement(reqs, {"simple": SIMPLE}, {}).calls.collect()}
    assert rows == {0: None, 1: "statement is blank", 2: "statement is blank", 3: "no such procedure: other"}
    assert {r["error"] for r in run_by_statement(reqs, {"simple": SIMPLE}, {}, "simple").calls.collect()} == {None}


def test_row_json(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, timestamp'2024-01-02 03:04:05' AS t, X'00ff' AS x, 1.50 AS d")
    assert df.select(row_json(df, df.columns)).first()[0] == (
        '{"a":1,"b":null,"t":"2024-01-02T03:04:05.000Z","x":"AP8=","d":1.50}'
    )
    assert json.loads(df.select(row_json(df, ["t"], True)).first()[0]) == {"t": 1704164645000}
    with pytest.raises(ValueError, match="same name"):
        row_json(df, ["a", "a"])


@pytest.mark.parametrize("piece_bytes", [10**9, 500, 1])
def test_hot_request_is_split_and_whole(spark, piece_bytes):
    """One request with more than a third of all rows; equal rows and a tie on the sort key among them."""
    hot = [(0, i // 2, "same" if i % 4 < 2 else f"é{i}") for i in range(900)]
    cold = [(k, i, "x") for k in range(1, 60) for i in range(k % 20)]
    table = spark.createDataFrame(hot + cold, "k bigint, n int, v string").repartition(5)
    procedure = Procedure(
        [Argument(1, "k", "bigint")],
        [
            Rows("SELECT request_id, n, v FROM {calls} c JOIN {data} d ON c.k = d.k", ["n"]),
            Count("SELECT request_id FROM {calls} c JOIN {data} d ON c.k = d.k"),
            Rows("SELECT request_id, n FROM {calls} c JOIN {data} d ON c.k = d.k WHERE d.n < 0"),
            Rows("SELECT request_id, n FROM {calls} c JOIN {data} d ON c.k = d.k WHERE d.n % 2 = 0", ["n"]),
        ],
        {2: lambda df: F.col("rows_4")},
    )
    reqs = requests(spark, *[{f"{P}.in.1.type": "-5", f"{P}.in.1.value": str(k)} for k in range(60)])
    done = run_calls(reqs, procedure, {"data": table}, {f"{P}.out.2.type": "4"}, piece_bytes=piece_bytes)
    pieces = {}
    for r in sorted(done.contents.collect(), key=lambda r: (r["request_id"], r["piece"])):
        pieces.setdefault(r["request_id"], []).append(r)
    calls = {r["request_id"]: r for r in done.calls.collect()}
    assert len(pieces) == len(calls) == 60 and all(c["attributes"] for c in calls.values())
    for k, parts in pieces.items():
        rows = sorted((n, v) for i, n, v in hot + cold if i == k)
        even = [{"n": n} for n, _ in rows if n % 2 == 0]
        content = "".join(p["content"] for p in parts)
        assert (len(parts), len(content.encode())) == (calls[k]["pieces"], calls[k]["bytes"]) and parts[0]["piece"] == 0
        found = json.loads(content)
        assert found["OUTPUTS"] == {"output_2": len(even)}
        if rows:
            # Rows with equal keys may come in any order, which is the same every time.
            got = found["RESULTS"].pop(0)
            assert [r["n"] for r in got] == [n for n, _ in rows]
            assert sorted((r["n"], r["v"]) for r in got) == rows
        assert found["RESULTS"] == [len(rows)] + ([even] if even else [])
    if piece_bytes == 500:
        assert len(pieces[0]) > 20 and max(len(p["content"]) for p in pieces[0]) < 1100
    if piece_bytes == 10**9:
        assert {len(p) for p in pieces.values()} == {1}


def test_equal_rows_take_more_than_one_task(spark):
    """Rows of one request that are equal in place and text are still dealt out."""
    one, zero = F.col("id") % 1 + 1, (F.col("id") % 1).cast("string")
    rows = spark.range(4000).select(
        one.alias("request_id"), F.struct(one.alias("n")).alias("place"), F.concat(F.lit("same"), zero).alias("row"),
        F.col("id").alias("row_id"),
    )
    found = result_pieces(rows, 1000)
    assert found.select("part").distinct().count() > 1
    assert sum(r["text"].count("same") for r in found.collect()) == 4000
    keys = found._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression [", 1)[1].split("]")[0]
    assert "row_hash" in keys and "row#" not in keys


def test_single_statement(spark):
    data = spark.range(10).withColumn("s", F.concat(F.lit("r"), F.col("id").cast("string")))
    given = {f"{P}.in.1.type": "-5", f"{P}.in.1.value": "4", f"{P}.in.2.type": "12", f"{P}.in.2.value": "r7"}
    text = "SELECT s FROM {data} WHERE id > ? AND s <= ? ORDER BY id"
    assert [r[0] for r in run_statement(spark, text, given, {"data": data}).collect()] == ["r5", "r6", "r7"]
    with pytest.raises(ValueError, match="not a valid BIGINT"):
        run_statement(spark, text, given | {f"{P}.in.1.value": "x"}, {"data": data})
    with pytest.raises(ValueError, match="blank"):
        run_statement(spark, "  ", given)


def _keyed(spark, n, **extra):
    return requests(spark, *[{f"{P}.in.1.type": "-5", f"{P}.in.1.value": str(k)} | extra for k in range(n)])


KEY = [Argument(1, "k", "bigint")]


def test_one_statement_for_all_requests(spark):
    """A statement with ``?`` gives each request what it gives when it runs for that request alone."""
    data = spark.range(300).selectExpr("id % 25 AS k", "id AS v", "CAST(id AS STRING) AS s")
    texts = [
        "SELECT v, s FROM {data} WHERE k = ? AND v > ? -- why? because\n",
        "SELECT v, '?' AS mark, \"is it?\" AS `q?` FROM {data} /* ? */ WHERE k = ? ORDER BY v DESC LIMIT ? + 1 - 30",
        "SELECT count(*) AS v, max(v) AS m FROM {data} WHERE k = ? AND v < ?;",
    ]
    given = [{f"{P}.in.1.type": "-5", f"{P}.in.1.value": str(k), f"{P}.in.2.type": "4", f"{P}.in.2.value": "31"} for k in range(30)]
    properties = {f"{P}.in.1.type": "-5", f"{P}.in.2.type": "4"}
    for text in (texts[0], texts[2]):
        done = run_statements(requests(spark, *given), text, {"data": data}, properties=properties, order_by=["v"])
        found = {r["request_id"]: json.loads(r["content"]) for r in done.contents.collect()}
        for k in (0, 7, 24, 29):
            alone = [r.asDict() for r in run_statement(spark, text.rstrip(";"), given[k], {"data": data}).orderBy("v").collect()]
            assert found[k]["RESULTS"] == ([alone] if alone else [])
    plan = spark.sql(for_all_calls(texts[0], [Argument(1, "k", "bigint"), Argument(2, "p", "int")]), calls=spark.createDataFrame([(1, 1, 1)], "request_id long, k long, p int"), data=data)
    assert "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()
    assert with_columns(texts[1], ["a", "b"]).count("?") == 4
    with pytest.raises(ValueError, match="has 2 parameters, 1 are given"):
        for_all_calls(texts[0], KEY)
    with pytest.raises(ValueError, match="without gaps"):
        for_all_calls(texts[0], [Argument(2, "k", "bigint")])
    with pytest.raises(ValueError, match="blank"):
        for_all_calls(" ", [])


def test_failures_stay_with_their_requests(spark):
    """Bodies that raise for some keys fail those requests only, each with its reason; other results are whole."""
    data = spark.range(120).selectExpr("id % 40 AS k", "id AS v")
    procedure = Procedure(
        KEY,
        [
            Rows("SELECT request_id, v, 100 DIV (k - 7) AS d FROM {calls} JOIN {data} USING (k)", ["v"]),
            Rows("SELECT request_id, CAST(concat(if(k IN (7, 11), 'x', ''), v) AS INT) AS n FROM {calls} JOIN {data} USING (k)", ["n"]),
        ],
        {2: lambda df: F.col("rows_2")},
    )
    done = run_calls(_keyed(spark, 40), procedure, {"data": data}, {f"{P}.out.2.type": "4"})
    calls = {r["request_id"]: r for r in done.calls.collect()}
    assert len(calls) == 40 and {k for k, r in calls.items() if r["route"] == "failure"} == {7, 11}
    assert calls[7]["error"].startswith("[DIVIDE_BY_ZERO]") and calls[11]["error"].startswith("[CAST_INVALID_INPUT]")
    contents = {r["request_id"]: json.loads(r["content"]) for r in done.contents.collect()}
    assert contents.keys() == calls.keys() - {7, 11}
    for k, c in contents.items():
        rows = [{"v": v, "d": int(100 / (k - 7))} for v in (k, k + 40, k + 80)]
        assert c == {"RESULTS": [rows, [{"n": r["v"]} for r in rows]], "OUTPUTS": {"output_2": 3}}
    with pytest.raises(AnalysisException):
        run_calls(_keyed(spark, 3), Procedure(KEY, [Rows("SELECT request_id, nowhere FROM {calls}")]), {})


def test_failing_requests_cost_a_run_each(spark):
    """What a column raises is found in one run, so that the failing requests run alone and the others together."""
    ran = []

    def body(calls, tables):
        ran.append(1)
        return calls.select("request_id", F.expr("CASE WHEN k % 100 = 7 THEN k DIV (k - k) WHEN k = 50 THEN CAST(CONCAT('x', k) AS INT) ELSE k END AS v"))

    done = run_calls(_keyed(spark, 300), Procedure(KEY, [Rows(body)]), {})
    errors = {r["request_id"]: r["error"] for r in done.calls.where("route = 'failure'").collect()}
    assert sorted(errors) == [7, 50, 107, 207]
    assert errors.pop(50).startswith("[CAST_INVALID_INPUT]") and all(e.startswith("[DIVIDE_BY_ZERO]") for e in errors.values())
    assert done.contents.count() == 296
    # All together, the look at the columns, four alone, the others.
    assert len(ran) == 7


def test_repeated_failing_request_is_refused(spark):
    twice = _keyed(spark, 20).unionByName(_keyed(spark, 20).where("request_id = 3"))
    with pytest.raises(RuntimeError, match="not unique"):
        run_calls(twice, Procedure(KEY, [Rows("SELECT request_id, k DIV (k - 3) AS v FROM {calls}")]), {})


def test_failures_outside_columns_are_found_by_parts(spark):
    """A condition raises before any column is worked out, in the look at the columns too; another request fails in a column."""
    body = "SELECT request_id, 1 DIV (k - 5) AS v FROM {calls} WHERE 1 DIV (k - 11) < 2"
    done = run_calls(_keyed(spark, 30), Procedure(KEY, [Rows(body)]), {})
    assert sorted(r["request_id"] for r in done.calls.where("route = 'failure'").collect()) == [5, 11]
    assert done.contents.count() == 28


def test_every_request_fails(spark):
    done = run_calls(_keyed(spark, 3), Procedure(KEY, [Rows("SELECT request_id, raise_error('no ' || k) AS x FROM {calls}")]), {})
    assert sorted(r["error"] for r in done.calls.collect()) == [f"[USER_RAISED_EXCEPTION] no {k}" for k in range(3)]
    assert done.contents.count() == 0


def test_one_slow_request_of_many(spark):
    @F.udf("long")
    def slow(k):
        time.sleep(60 if k == 5 else 0)
        return k

    def body(calls, tables):
        return calls.select("request_id", slow("k").alias("x"))

    start = time.monotonic()
    done = run_calls(_keyed(spark, 12), Procedure(KEY, [Rows(body)]), {}, limit_millis=6000)
    calls = {r["request_id"]: r["error"] for r in done.calls.collect()}
    assert calls == {k: "time limit of 6000 ms exceeded" if k == 5 else None for k in range(12)}
    assert done.contents.count() == 11 and time.monotonic() - start < 100


def test_steps_that_write(spark, tmp_path):
    """Rows are written once however often the job runs; later steps see them; counts are of what was written."""
    audit = WrittenTable(spark, str(tmp_path / "audit"), "k bigint, note string")
    data = spark.range(30).selectExpr("id % 10 AS k", "CAST(id AS STRING) AS note")
    procedure = Procedure(
        KEY,
        [
            Insert("SELECT request_id, k, note FROM {calls} JOIN {data} USING (k)", "audit"),
            Rows("SELECT c.request_id, count(a.k) AS n FROM {calls} c LEFT JOIN {audit} a ON a.k = c.k GROUP BY c.request_id"),
            Insert("SELECT request_id, k, 'second' AS note FROM {calls} WHERE k < 2", "audit"),
        ],
    )
    tables = {"data": data, "audit": audit}

    def run(n, name, steps=procedure):
        done = run_calls(_keyed(spark, n), steps, tables, run=name)
        return {r["request_id"]: json.loads(r["content"])["RESULTS"] for r in done.contents.collect()}

    expected = {k: [3 if k < 10 else 0, [{"n": 3 if k < 10 else 0}], int(k < 2)] for k in range(12)}
    assert run(12, "monday") == expected
    rows = sorted(map(tuple, audit.rows().collect()))
    assert rows == sorted([(i % 10, str(i)) for i in range(30)] + [(0, "second"), (1, "second")])
    # Again under the same name: the same counts, no row more. (The second step reads what is there by now.)
    again = run(12, "monday")
    assert {k: [r[0], r[2]] for k, r in again.items()} == {k: [r[0], r[2]] for k, r in expected.items()}
    assert sorted(map(tuple, audit.rows().collect())) == rows
    run(2, "tuesday")
    assert audit.rows().count() == len(rows) + 8
    with pytest.raises(ValueError, match="not a table that can be written"):
        run_calls(_keyed(spark, 1), procedure, {"data": data, "audit": data})


def test_a_job_that_ended_half_way(spark, tmp_path):
    """Requests whose rows are in the table are not written again; rows without a manifest are in no table."""
    table = WrittenTable(spark, str(tmp_path / "t"), "k bigint")
    body = Insert("SELECT request_id, k FROM {calls} WHERE 10 DIV (k - 3) < 100", "t")
    done = run_calls(_keyed(spark, 6), Procedure(KEY, [body]), {"t": table}, run="r")
    assert {r["request_id"]: r["route"] for r in done.calls.collect()} == {k: "failure" if k == 3 else "success" for k in range(6)}
    assert sorted(r["k"] for r in table.rows().collect()) == [0, 1, 2, 4, 5]
    attempt = table.manifest("r", 1).where("n > 0").first()["attempt"]
    delete_folder(spark, f"{table.path}/manifest/run=r/step=1/attempt={attempt}")
    lost = {0, 1, 2, 4, 5} - {r["k"] for r in table.rows().collect()}
    assert lost
    good = Insert("SELECT request_id, k FROM {calls}", "t")
    run_calls(_keyed(spark, 6), Procedure(KEY, [good]), {"t": table}, run="r")
    assert sorted(r["k"] for r in table.rows().collect()) == [0, 1, 2, 3, 4, 5]
    assert table.manifest("r", 1).agg(F.sum("n")).first()[0] == 6


def test_two_jobs_of_one_run_at_once(spark, tmp_path):
    """Both have written for the same requests: one of each counts."""
    table = WrittenTable(spark, str(tmp_path / "t"), "k bigint")
    calls = spark.range(5).selectExpr("id AS request_id", "id AS k")

    def meanwhile(todo):
        if not table._attempts("r", 1):
            table.add(calls, lambda some: some, "r", 1)
        return todo

    assert table.add(calls, meanwhile, "r", 1).agg(F.sum("n")).first()[0] == 5
    assert len(table._attempts("r", 1)) == 2
    assert sorted(r["k"] for r in table.rows().collect()) == [0, 1, 2, 3, 4]


def test_requests_are_read_once_for_all_procedures(spark):
    name = "stored.procedure.statement"
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    reqs = requests(spark, *[GOOD | {name: f"p{k % 6}"} for k in range(12)])
    reqs = reqs.select("request_id", F.map_concat("attributes", F.create_map(F.lit("seen"), counted(F.lit("x")))).alias("attributes"))
    done = run_by_statement(reqs, {f"p{k}": SIMPLE for k in range(5)}, {})
    rows = {r["request_id"]: r["error"] for r in done.calls.collect()}
    assert {k for k, e in rows.items() if e} == {5, 11} and len(rows) == 12
    assert seen.value == 12


def test_declared_output_types(spark):
    """An output has the type that its parameter declares; one that the type cannot hold fails its request."""
    procedure = Procedure(KEY, [], {2: lambda df: F.col("k") * 2, 3: lambda df: F.concat(F.lit("4"), F.when(F.col("k") == 1, "x").otherwise(""))})
    declared = [("4", "12"), ("12", "4"), ("8", "-5"), ("3", "-7"), ("-7", "12"), ("2", "1111")]
    given = [{f"{P}.in.1.type": "-5", f"{P}.in.1.value": str(k), f"{P}.out.2.type": a, f"{P}.out.3.type": b} for k, (a, b) in enumerate(declared)]
    done = run_calls(requests(spark, *given), procedure, {})
    calls = {r["request_id"]: r["error"] for r in done.calls.collect()}
    found = {r["request_id"]: r["content"][len('{"OUTPUTS":') : -1] for r in done.contents.collect()}
    assert found[0] == '{"output_2":0,"output_3":"4"}'
    assert calls[1] == "output 3: '4x' is not a valid INTEGER"
    assert found[2] == '{"output_2":4.0,"output_3":4}'
    assert calls[3] == "output 3: '4' is not a valid BIT"
    assert calls[4] == "output 2: '8' is not a valid BIT"
    assert found[5] == '{"output_2":10,"output_3":"4"}'
    assert found.keys() == {0, 2, 5}


def test_places_of_pieces_in_two_levels(spark):
    """Against one walk over the pieces of each request; a request has many parts, some with one piece."""
    rnd, rows = random.Random(4), []
    for request in (1, 2, None):
        for step in range(4):
            rows.append((request, step, -1, -1, "["))
            rows += [(request, step, part, seq, "x" * rnd.randint(1, 9)) for part in range(rnd.randint(0, 5)) for seq in range(rnd.randint(1, 6))]
    want = []
    for request in (1, 2):
        mine, before = sorted(r for r in rows if r[0] == request), 0
        for i, r in enumerate(mine):
            want.append((*r, before, sum(q[1] == r[1] and q[3] >= 0 for q in mine[:i])))
            before += len(r[4])
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "request_id int, step int, part long, seq long, text string")
    got = document_places(df, F.octet_length("text"), F.col("seq") >= 0)
    assert sorted(map(tuple, got.collect())) == want


def test_binding_is_dealt_out_to_tasks(spark):
    """Requests of one file with one row group are bound by many tasks."""
    given = F.create_map(F.lit("procedure.args.in.1.type"), F.lit("-5"), F.lit("procedure.args.in.1.value"), F.col("id").cast("string"))
    reqs = spark.range(0, 400, 1, 1).select(F.col("id").alias("request_id"), given.alias("attributes"))
    bound = bind_requests(reqs, Procedure([Argument(1, "a", "bigint")]), {})
    tasks = bound.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in tasks) < 200
    assert bound.where("a = request_id AND error IS NULL").count() == 400
