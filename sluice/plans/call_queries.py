"""Queries of parameters and calls: one request per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.calls import (
    Count,
    Insert,
    Procedure,
    Rows,
    bind_requests,
    result_pieces,
    result_rows,
    run_by_statement,
    run_calls,
    run_statement,
    run_statements,
)
from sluice.operators.parameters import (
    STATEMENT,
    Argument,
    parameter_rows,
    statement,
    statement_error,
    with_parameters,
)
from sluice.operators.writes import WrittenTable
from sluice.plans.tables import table
from sluice.session import work_folder, written

PREFIX = "procedure.args"
PROPERTIES = {
    f"{PREFIX}.in.1.type": "12",
    f"{PREFIX}.in.1.value": "BUILDING",
    f"{PREFIX}.in.2.type": "8",
    f"{PREFIX}.in.2.value": "0",
    f"{PREFIX}.out.3.type": "4",
}


def requests(spark: SparkSession, sf: str, with_key: bool = False) -> DataFrame:
    """Customers as call requests; ``with_key`` adds the customer key as parameter 5."""
    key = F.col("c_custkey")
    key_text = key.cast("string")
    bad = key % 11 == 0
    balance = (key % 3 == 0) & ~bad
    stray = (key % 5 == 0) & (key % 3 != 0) & ~bad

    def when(condition: Column, name: str, value: Column | str) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return F.when(condition, F.struct(F.lit(name).alias("name"), value.alias("value")))

    always = F.lit(True)
    entries = [
        when(key % 2 == 0, f"{PREFIX}.in.1.type", "12"),
        when(key % 2 == 0, f"{PREFIX}.in.1.value", F.col("c_mktsegment")),
        when(balance, f"{PREFIX}.in.2.type", "8"),
        when(bad, f"{PREFIX}.in.2.type", "4"),
        when(balance, f"{PREFIX}.in.2.value", F.col("c_acctbal").cast("string")),
        when(bad, f"{PREFIX}.in.2.value", "not a number"),
        when(stray, f"{PREFIX}.in.2.value", "999999"),
        when(key % 7 == 0, f"{PREFIX}.out.3.type", "4"),
        when(key % 7 == 0, f"{PREFIX}.out.3.name", "ID"),
        when(key % 13 == 0, f"{PREFIX}.inout.4.type", "-5"),
        when(key % 13 == 0, f"{PREFIX}.inout.4.value", key_text),
        when(key % 13 == 0, f"{PREFIX}.inout.4.name", "KEY"),
        when(always, "other.attribute", "x"),
        when(key % 4 == 0, STATEMENT, "customer_report"),
        when(key % 4 == 1, STATEMENT, "  "),
        when(key % 4 == 2, STATEMENT, "unknown_report"),
    ]
    if with_key:
        entries += [
            when(always, f"{PREFIX}.in.5.type", "-5"),
            when(always, f"{PREFIX}.in.5.value", key_text),
        ]
    present = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return table(spark, sf, "customer").select(
        key.alias("request_id"), F.map_from_entries(present).alias("attributes")
    )


ARGUMENTS = [
    Argument(1, "p1", "string"),
    Argument(2, "p2", "double"),
    Argument(4, "p4", "bigint", required=False),
    Argument(5, "p5", "bigint"),
]
ORDERS_STEP = Rows(
    """SELECT c.request_id, o.o_orderkey, o.o_totalprice, o.o_orderstatus
       FROM {calls} c JOIN {orders} o ON o.o_custkey = c.p5 AND o.o_totalprice >= c.p2""",
    ["o_orderkey"],
)
NATION_STEP = Rows(
    """SELECT DISTINCT c.request_id, n.n_nationkey, n.n_name, u.c_mktsegment AS segment
       FROM {calls} c JOIN {customer} u ON u.c_custkey = c.p5 AND u.c_mktsegment = c.p1
       JOIN {nation} n ON n.n_nationkey = u.c_nationkey""",
    ["n_nationkey"],
)
EMPTY_STEP = Rows("SELECT c.request_id, c.p1 FROM {calls} c WHERE c.p2 < -1e300")
LINES_STEP = Count(
    """SELECT c.request_id FROM {calls} c JOIN {orders} o ON o.o_custkey = c.p5 AND o.o_totalprice >= c.p2
       JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey"""
)
DOCUMENT_STEP = Rows(
    """SELECT c.request_id, d.doc_id, d.text, CAST(NULL AS STRING) AS note
       FROM {calls} c JOIN {documents} d ON d.doc_id = c.p5""",
    ["doc_id"],
)
OUTPUTS = {3: lambda df: F.col("rows_1"), 4: lambda df: F.col("p4") + 1}
REPORT = Procedure(ARGUMENTS, [ORDERS_STEP, NATION_STEP, EMPTY_STEP, LINES_STEP, DOCUMENT_STEP], OUTPUTS)


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: table(spark, sf, t) for t in ("customer", "nation", "orders", "lineitem", "documents")}


def _accepted(spark: SparkSession, sf: str) -> DataFrame:
    bound = written(bind_requests(requests(spark, sf, True), REPORT, PROPERTIES), "calls")
    return bound.where("error IS NULL").select("request_id", "p1", "p2", "p4", "p5")


def param_rows(spark: SparkSession, sf: str) -> DataFrame:
    return parameter_rows(with_parameters(requests(spark, sf)))


def param_merge(spark: SparkSession, sf: str) -> DataFrame:
    return parameter_rows(with_parameters(requests(spark, sf), PROPERTIES))


def param_types(spark: SparkSession, sf: str) -> DataFrame:
    bound = bind_requests(requests(spark, sf, True), REPORT, PROPERTIES)
    return bound.select("request_id", "p1", "p2", "p4", "p5", "error")


def param_big_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of 22 to 26 digits as double, float, decimal and bigint: taken where the type holds just that number."""
    key = F.col("c_custkey")
    digits = F.when(key % 2 == 0, F.concat(F.lit("1"), key.cast("string"), F.lit("0" * 21))).otherwise(F.concat(F.lit("123456789012345678901"), key.cast("string")))
    names = [(i, n, x) for i in range(1, 5) for n, x in (("type", F.lit("3")), ("value", digits))]
    given = F.create_map(*[c for i, n, x in names for c in (F.lit(f"{PREFIX}.in.{i}.{n}"), x)])
    reqs = table(spark, sf, "customer").select(key.alias("request_id"), given.alias("attributes"))
    kinds = {"as_double": "double", "as_float": "float", "as_decimal": "decimal(38,0)", "as_bigint": "bigint"}
    bound = bind_requests(reqs, Procedure([Argument(i, n, t) for i, (n, t) in enumerate(kinds.items(), 1)]), {})
    shown = [F.col("as_float").cast("double").alias("as_float"), F.col("as_decimal").cast("string").alias("as_decimal")]
    return bound.select("request_id", "as_double", *shown, "as_bigint", "error")


def statement_choice(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for label, text in (("set", "from_property"), ("absent", None)):
        one = requests(spark, sf).withColumn("statement", statement(text)).select(
            F.lit(label).alias("property"), "request_id", "statement", statement_error(F.col("statement")).alias("error")
        )
        out = one if out is None else out.unionByName(one)
    return out


def call_single(spark: SparkSession, sf: str) -> DataFrame:
    given = {
        f"{PREFIX}.in.1.type": "12", f"{PREFIX}.in.1.value": "2-HIGH",
        f"{PREFIX}.in.2.type": "91", f"{PREFIX}.in.2.value": "1997-06-30",
        f"{PREFIX}.in.3.type": "3", f"{PREFIX}.in.3.value": "1e5",
    }
    text = """SELECT o_orderkey, o_totalprice FROM {orders}
              WHERE o_orderpriority = ? AND CAST(o_orderdate AS DATE) >= ? AND o_totalprice >= ?"""
    return run_statement(spark, text, given, {"orders": table(spark, sf, "orders")})


def _contents(spark: SparkSession, sf: str, procedure: Procedure, **options) -> DataFrame:
    return run_calls(requests(spark, sf, True), procedure, _tables(spark, sf), PROPERTIES, **options).contents


def call_results(spark: SparkSession, sf: str) -> DataFrame:
    return _contents(spark, sf, Procedure(ARGUMENTS, [ORDERS_STEP, NATION_STEP, EMPTY_STEP], OUTPUTS))


def call_update_counts(spark: SparkSession, sf: str) -> DataFrame:
    outputs = {3: lambda df: F.col("rows_1"), 4: lambda df: F.col("p4")}
    return _contents(spark, sf, Procedure(ARGUMENTS, [LINES_STEP], outputs))


def call_rows_json(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of one step as JSON text, one row to a piece."""
    rows = result_rows(DOCUMENT_STEP, _accepted(spark, sf), _tables(spark, sf))
    stored = written(rows.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    return result_pieces(stored, 1).select("request_id", "text")


def call_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs in their declared types: output 3 is text, where the request does not say that it is a number."""
    outputs = {3: lambda df: F.col("p5") * 2, 4: lambda df: F.col("p4") + 1}
    properties = PROPERTIES | {f"{PREFIX}.out.3.type": "12"}
    return run_calls(requests(spark, sf, True), Procedure(ARGUMENTS, [], outputs), _tables(spark, sf), properties).contents


def call_document(spark: SparkSession, sf: str) -> DataFrame:
    return _contents(spark, sf, REPORT)


# Objects of a document, none of which is split between pieces.
OBJECTS = r'(?s)\{"o_orderkey":[^}]*\}|\{"n_nationkey":[^}]*\}|\{"doc_id":.*?,"note":null\}|"OUTPUTS":\{[^}]*\}'


def call_document_split(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in pieces of 1 KiB: their bytes, the objects in them with the sum of their hashes, and whether order rows are in order."""
    pieces = _contents(spark, sf, REPORT, piece_bytes=1024)
    keys = F.transform(F.regexp_extract_all("content", F.lit(r'"o_orderkey":(\d+)'), F.lit(1)), lambda k: k.cast("bigint"))
    objects = F.regexp_extract_all("content", F.lit(OBJECTS), F.lit(0))
    hashes = F.transform(objects, lambda o: F.conv(F.substring(F.md5(o), 1, 12), 16, 10).cast("bigint"))
    found = pieces.select("request_id", "piece", F.octet_length("content").alias("bytes"), keys.alias("keys"), hashes.alias("hashes"))
    before = F.expr("max(array_max(keys)) OVER (PARTITION BY request_id ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    checked = found.withColumn(
        "ordered", (F.col("keys") == F.array_sort("keys")) & F.coalesce(F.array_min("keys") > before, F.lit(True))
    )
    total = F.aggregate("hashes", F.lit(0).cast("bigint"), lambda a, h: a + h)
    return checked.groupBy("request_id").agg(
        F.sum("bytes").alias("bytes"), F.sum(F.size("keys")).alias("order_rows"), F.bool_and("ordered").alias("in_order"),
        F.sum(F.size("hashes")).alias("objects"), F.sum(total).alias("object_hashes"),
    )


STATEMENT_TEXT = """SELECT o_orderkey, o_totalprice FROM {orders} -- each request's own, if dear enough?
    WHERE o_custkey = ? AND o_totalprice >= ?"""


def call_statement_all(spark: SparkSession, sf: str) -> DataFrame:
    """One ``?`` statement for every customer, the customer's balance tenfold as second parameter."""
    key, least = F.col("c_custkey").cast("string"), (F.round(F.col("c_acctbal"), 0) * 10).cast("bigint").cast("string")
    given = F.create_map(F.lit(f"{PREFIX}.in.1.type"), F.lit("-5"), F.lit(f"{PREFIX}.in.1.value"), key,
                         F.lit(f"{PREFIX}.in.2.type"), F.lit("8"), F.lit(f"{PREFIX}.in.2.value"), least)
    reqs = table(spark, sf, "customer").select(F.col("c_custkey").alias("request_id"), given.alias("attributes"))
    declared = {f"{PREFIX}.in.1.type": "-5", f"{PREFIX}.in.2.type": "8"}
    orders = {"orders": table(spark, sf, "orders")}
    return run_statements(reqs, STATEMENT_TEXT, orders, properties=declared, order_by=["o_orderkey"]).contents


FAILING = 1009


def call_isolated(spark: SparkSession, sf: str) -> DataFrame:
    """A body that divides by zero for some customers: those fail, all others have their rows."""
    step = Rows(
        f"""SELECT c.request_id, o.o_orderkey, CAST(o.o_orderkey AS BIGINT) DIV (c.p5 % {FAILING} - 7) AS part
            FROM {{calls}} c JOIN {{orders}} o ON o.o_custkey = c.p5""",
        ["o_orderkey"],
    )
    done = run_calls(requests(spark, sf, True), Procedure(ARGUMENTS, [step], OUTPUTS), _tables(spark, sf), PROPERTIES)
    rows = done.contents.groupBy("request_id").agg(F.md5(F.max("content")).alias("content_md5"))
    return done.calls.join(rows, "request_id", "left").select(
        "request_id", "route", F.regexp_extract("error", r"^(\[[A-Z_]+\]|.*)", 1).alias("error"), "content_md5"
    )


def call_writes(spark: SparkSession, sf: str) -> DataFrame:
    """Steps that write, in a job that runs twice under one name: counts of the document, and the rows in the table."""
    audit = WrittenTable(spark, work_folder(spark, "audit"), "custkey bigint, orderkey bigint, price double")
    procedure = Procedure(
        ARGUMENTS,
        [
            Insert(
                """SELECT c.request_id, c.p5 AS custkey, o.o_orderkey AS orderkey, o.o_totalprice AS price
                   FROM {calls} c JOIN {orders} o ON o.o_custkey = c.p5 AND o.o_totalprice >= c.p2""",
                "audit",
            ),
            Count("SELECT c.request_id FROM {calls} c JOIN {audit} a ON a.custkey = c.p5"),
        ],
        {3: lambda df: F.col("rows_1"), 4: lambda df: F.col("p4")},
    )
    for _ in range(2):
        done = run_calls(requests(spark, sf, True), procedure, {**_tables(spark, sf), "audit": audit}, PROPERTIES, run="report")
    rows = audit.rows().groupBy("custkey").agg(F.count("*").alias("n_rows"), F.sum("orderkey").alias("orderkeys"), F.max("price").alias("highest"))
    return done.contents.join(rows, F.col("request_id") == F.col("custkey"), "left").select("request_id", "content", "n_rows", "orderkeys", "highest")


def _routes(spark: SparkSession, sf: str, **options) -> DataFrame:
    done = run_by_statement(
        requests(spark, sf, True), {"customer_report": REPORT}, _tables(spark, sf), properties=PROPERTIES, **options
    )
    return done.calls.select(
        "request_id", "route", "error", F.col("attributes")["other.attribute"].alias("carried"),
        F.size("attributes").alias("n_attributes"), (F.col("pieces") > 0).alias("has_content"),
    )


def call_routes(spark: SparkSession, sf: str) -> DataFrame:
    return _routes(spark, sf)


def call_routes_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same with documents in pieces of 1 KiB."""
    return _routes(spark, sf, piece_bytes=1024)


def call_timing(spark: SparkSession, sf: str) -> DataFrame:
    done = run_calls(requests(spark, sf, True), REPORT, _tables(spark, sf), PROPERTIES)
    return done.calls.select("request_id", "route", (F.col("duration_ms") >= 0).alias("timed"))


QUERIES = {
    f.__name__: f
    for f in (
        param_rows, param_merge, param_types, param_big_numbers, statement_choice, call_single, call_results, call_update_counts,
        call_rows_json, call_outputs, call_document, call_document_split, call_routes, call_routes_split,
        call_timing, call_statement_all, call_isolated, call_writes,
    )
}

_REQUESTS = """
r AS (SELECT c_custkey AS k, c_custkey % 11 = 0 AS bad, * FROM customer),
own AS (
  SELECT k AS request_id, 1 AS index, 'in' AS direction, 12 AS jdbc_type, 'VARCHAR' AS type_name,
         c_mktsegment AS value, CAST(NULL AS VARCHAR) AS name FROM r WHERE k % 2 = 0
  UNION ALL SELECT k, 2, 'in', 8, 'DOUBLE', CAST(c_acctbal AS VARCHAR), NULL FROM r WHERE k % 3 = 0 AND NOT bad
  UNION ALL SELECT k, 2, 'in', 4, 'INTEGER', 'not a number', NULL FROM r WHERE bad
  UNION ALL SELECT k, 3, 'out', 4, 'INTEGER', NULL, 'ID' FROM r WHERE k % 7 = 0
  UNION ALL SELECT k, 4, 'inout', -5, 'BIGINT', CAST(k AS VARCHAR), 'KEY' FROM r WHERE k % 13 = 0
)"""
_PROPERTIES = """
property AS (
  SELECT c_custkey AS request_id, p.* FROM customer, (VALUES
    (1, 'in', 12, 'VARCHAR', 'BUILDING'), (2, 'in', 8, 'DOUBLE', '0'), (3, 'out', 4, 'INTEGER', NULL))
    AS p(index, direction, jdbc_type, type_name, value)
), merged AS (
  SELECT coalesce(o.request_id, p.request_id) AS request_id, coalesce(o.index, p.index) AS index,
         coalesce(o.direction, p.direction) AS direction, coalesce(o.jdbc_type, p.jdbc_type) AS jdbc_type,
         coalesce(o.type_name, p.type_name) AS type_name, coalesce(o.value, p.value) AS value, o.name AS name
  FROM own o FULL JOIN property p ON o.request_id = p.request_id AND o.index = p.index
)"""
_LIST = """SELECT request_id, index, direction, jdbc_type, type_name, value, CAST(NULL AS VARCHAR) AS format, name,
    CAST(NULL AS VARCHAR) AS error, direction <> 'out' AS is_bound, direction <> 'in' AS is_output"""
# One row per accepted request with its arguments and outputs.
_CALLS = """
calls AS (
  SELECT c_custkey AS request_id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'BUILDING' END AS p1,
         CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 0 END AS p2,
         CASE WHEN c_custkey % 13 = 0 THEN c_custkey END AS p4, c_custkey AS p5,
         CASE WHEN c_custkey % 7 = 0 THEN 'ID' ELSE 'output_3' END AS out3
  FROM customer WHERE c_custkey % 11 <> 0
), step1 AS (
  SELECT request_id, count(*) AS n, '[' || string_agg('{"o_orderkey":' || o_orderkey || ',"o_totalprice":' ||
         CAST(o_totalprice AS VARCHAR) || ',"o_orderstatus":"' || o_orderstatus || '"}', ',' ORDER BY o_orderkey)
         || ']' AS result
  FROM calls JOIN orders ON o_custkey = p5 AND o_totalprice >= p2 GROUP BY request_id
), step2 AS (
  SELECT request_id, '[{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","segment":"' || c_mktsegment
         || '"}]' AS result
  FROM calls JOIN customer ON c_custkey = p5 AND c_mktsegment = p1 JOIN nation ON n_nationkey = c_nationkey
), step4 AS (
  SELECT request_id, count(*) AS n FROM calls JOIN orders ON o_custkey = p5 AND o_totalprice >= p2
  JOIN lineitem ON l_orderkey = o_orderkey GROUP BY request_id
), step5 AS (
  SELECT request_id, '[{"doc_id":' || doc_id || ',"text":' || CAST(to_json(text) AS VARCHAR) || ',"note":null}]' AS result
  FROM calls JOIN documents ON doc_id = p5
), frame AS (
  SELECT c.*, s1.result AS r1, coalesce(s1.n, 0) AS n1, s2.result AS r2, coalesce(s4.n, 0) AS n4, s5.result AS r5
  FROM calls c LEFT JOIN step1 s1 USING (request_id) LEFT JOIN step2 s2 USING (request_id)
  LEFT JOIN step4 s4 USING (request_id) LEFT JOIN step5 s5 USING (request_id)
)"""


def _outputs(third: str, fourth: str) -> str:
    return f"""'{{' || concat_ws(',', '"' || out3 || '":' || ({third}), '"KEY":' || ({fourth})) || '}}'"""


_DOCUMENT = f"""WITH {_CALLS} SELECT request_id, '{{"RESULTS":[' || concat_ws(',', r1, r2, CAST(n4 AS VARCHAR), r5)
    || '],"OUTPUTS":' || {_outputs('n1', 'p4 + 1')} || '}}' AS content FROM frame"""
_PIECE = "SELECT request_id, 0::BIGINT AS piece, content FROM"
_ROUTES = """SELECT request_id, CASE WHEN error IS NULL THEN 'success' ELSE 'failure' END AS route, error,
          'x' AS carried, n_attributes, error IS NULL AS has_content
        FROM (SELECT k AS request_id,
            CASE WHEN k % 4 IN (1, 3) THEN 'statement is blank' WHEN k % 4 = 2 THEN 'no such procedure: unknown_report'
                 WHEN k % 11 = 0 THEN 'parameter 2: ''not a number'' is not a valid INTEGER' END AS error,
            3 + CASE WHEN k % 2 = 0 THEN 2 ELSE 0 END + CASE WHEN k % 3 = 0 OR k % 11 = 0 THEN 2 ELSE 0 END
              + CASE WHEN k % 5 = 0 AND k % 3 <> 0 AND k % 11 <> 0 THEN 1 ELSE 0 END
              + CASE WHEN k % 7 = 0 THEN 2 ELSE 0 END + CASE WHEN k % 13 = 0 THEN 3 ELSE 0 END
              + CASE WHEN k % 4 <> 3 THEN 1 ELSE 0 END AS n_attributes
          FROM (SELECT c_custkey AS k FROM customer))"""
SQL = {
    "param_rows": f"WITH {_REQUESTS} {_LIST} FROM own",
    "param_merge": f"WITH {_REQUESTS}, {_PROPERTIES} {_LIST} FROM merged",
    "param_types": """SELECT c_custkey AS request_id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'BUILDING' END AS p1,
        CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 0.0 END AS p2,
        CASE WHEN c_custkey % 13 = 0 THEN c_custkey END AS p4, c_custkey AS p5,
        CASE WHEN c_custkey % 11 = 0 THEN 'parameter 2: ''not a number'' is not a valid INTEGER' END AS error
        FROM customer""",
    "param_big_numbers": """SELECT request_id, CASE WHEN even THEN CAST(t AS DOUBLE) END AS as_double,
          CASE WHEN even THEN CAST(CAST(t AS FLOAT) AS DOUBLE) END AS as_float, t AS as_decimal, CAST(NULL AS BIGINT) AS as_bigint,
          CASE WHEN even THEN concat('parameter 4: ''', t, ''' cannot be used as bigint')
               ELSE concat('parameter 1: ''', t, ''' cannot be used as double') END AS error
        FROM (SELECT c_custkey AS request_id, c_custkey % 2 = 0 AS even,
          CASE WHEN c_custkey % 2 = 0 THEN '1' || c_custkey || repeat('0', 21) ELSE '123456789012345678901' || c_custkey END AS t FROM customer)""",
    "statement_choice": """SELECT 'set' AS property, c_custkey AS request_id, 'from_property' AS statement,
          CAST(NULL AS VARCHAR) AS error FROM customer
        UNION ALL SELECT 'absent', c_custkey,
          CASE c_custkey % 4 WHEN 0 THEN 'customer_report' WHEN 1 THEN '  ' WHEN 2 THEN 'unknown_report' END,
          CASE WHEN c_custkey % 4 IN (1, 3) THEN 'statement is blank' END FROM customer""",
    "call_single": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'
        AND CAST(o_orderdate AS DATE) >= DATE '1997-06-30' AND o_totalprice >= 100000""",
    "call_results": f"""{_PIECE} (WITH {_CALLS} SELECT request_id, '{{"RESULTS":[' || concat_ws(',', r1, r2) || '],"OUTPUTS":'
        || {_outputs('n1', 'p4 + 1')} || '}}' AS content FROM frame)""",
    "call_update_counts": f"""{_PIECE} (WITH {_CALLS} SELECT request_id, '{{"RESULTS":[' || n4 || '],"OUTPUTS":'
        || {_outputs('n4', 'p4')} || '}}' AS content FROM frame)""",
    "call_rows_json": f"""WITH {_CALLS} SELECT request_id, result[2:-2] AS text FROM step5""",
    "call_outputs": f"""{_PIECE} (WITH {_CALLS} SELECT request_id, '{{"OUTPUTS":'
        || {_outputs("CASE WHEN p5 % 7 = 0 THEN (p5 * 2)::VARCHAR ELSE '\"' || (p5 * 2) || '\"' END", 'p4 + 1')} || '}}' AS content FROM calls)""",
    "call_document": f"{_PIECE} ({_DOCUMENT})",
    "call_document_split": f"""SELECT request_id, strlen(content)::BIGINT AS bytes, coalesce(n, 0)::BIGINT AS order_rows, TRUE AS in_order,
          len(o)::BIGINT AS objects, list_sum(list_transform(o, lambda x: ('0x' || md5(x)[1:12])::BIGINT))::BIGINT AS object_hashes
        FROM (SELECT *, regexp_extract_all(content, '{OBJECTS}') AS o FROM ({_DOCUMENT}))
        LEFT JOIN (SELECT c_custkey AS request_id, count(*) AS n FROM customer JOIN orders
          ON o_custkey = c_custkey AND o_totalprice >= CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 0 END GROUP BY 1) USING (request_id)""",
    "call_statement_all": f"""{_PIECE} (SELECT c_custkey AS request_id, '{{"RESULTS":[' || coalesce('[' || string_agg('{{"o_orderkey":' || o_orderkey
          || ',"o_totalprice":' || CAST(o_totalprice AS VARCHAR) || '}}', ',' ORDER BY o_orderkey) || ']', '') || ']}}' AS content
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice >= round(c_acctbal) * 10 GROUP BY c_custkey)""",
    "call_isolated": f"""WITH {_CALLS}, parts AS (
          SELECT request_id, string_agg('{{"o_orderkey":' || o_orderkey || ',"part":' || (o_orderkey // (p5 % {FAILING} - 7)) || '}}', ','
            ORDER BY o_orderkey) AS result, count(*) AS n
          FROM calls JOIN orders ON o_custkey = p5 WHERE p5 % {FAILING} <> 7 GROUP BY request_id
        ), good AS (
          SELECT request_id, '{{"RESULTS":[' || coalesce('[' || result || ']', '') || '],"OUTPUTS":' || {_outputs('coalesce(n, 0)', 'p4 + 1')}
            || '}}' AS content FROM calls LEFT JOIN parts USING (request_id)
          WHERE p5 % {FAILING} <> 7 OR p5 NOT IN (SELECT o_custkey FROM orders)
        )
        SELECT c_custkey AS request_id, CASE WHEN content IS NULL THEN 'failure' ELSE 'success' END AS route,
          CASE WHEN c_custkey % 11 = 0 THEN 'parameter 2: ''not a number'' is not a valid INTEGER'
               WHEN content IS NULL THEN '[DIVIDE_BY_ZERO]' END AS error, md5(content) AS content_md5
        FROM customer LEFT JOIN good ON request_id = c_custkey""",
    "call_writes": f"""WITH {_CALLS}, written AS (
          SELECT request_id, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS orderkeys, max(o_totalprice) AS highest
          FROM calls JOIN orders ON o_custkey = p5 AND o_totalprice >= p2 GROUP BY request_id)
        SELECT request_id, '{{"RESULTS":[' || coalesce(n_rows, 0) || ',' || coalesce(n_rows, 0) || '],"OUTPUTS":'
          || {_outputs('coalesce(n_rows, 0)', 'p4')} || '}}' AS content, n_rows, orderkeys, highest
        FROM calls LEFT JOIN written USING (request_id)""",
    "call_routes": _ROUTES,
    "call_routes_split": _ROUTES,
    "call_timing": """SELECT c_custkey AS request_id, CASE WHEN c_custkey % 11 = 0 THEN 'failure' ELSE 'success' END AS route,
        CASE WHEN c_custkey % 11 <> 0 THEN TRUE END AS timed FROM customer""",
}
