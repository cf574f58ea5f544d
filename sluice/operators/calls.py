"""Procedures over whole tables of requests, and one JSON document per request.

A procedure is an ordered list of steps. Each step is one DataFrame over all
requests at once, so a table of requests costs one job per step, never a loop
over requests.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from sluice.functions.json_text import json_scalar
from sluice.functions.temporal import let
from sluice.operators.isolation import Failure, settle
from sluice.operators.joining import join_runs
from sluice.operators.parameters import (
    FAILURE,
    SPARK_TYPES,
    SUCCESS,
    Argument,
    bind_arguments,
    is_output,
    parameter_rows,
    statement,
    statement_error,
    with_parameters,
)
from sluice.operators.statements import declared_arguments, for_all_calls, with_columns
from sluice.operators.writes import WrittenTable
from sluice.session import Scratch, side_by_side, written

Body = Callable[[DataFrame, dict[str, DataFrame]], DataFrame] | str
DEFAULT_PIECE_BYTES = 8 * 1024 * 1024


@dataclass(frozen=True)
class Rows:
    """A step that returns rows: ``request_id`` and the columns of the result, in order of ``order_by``."""

    body: Body
    order_by: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Count:
    """A step that returns a row count: one row of ``body`` per changed row."""

    body: Body


@dataclass(frozen=True)
class Insert:
    """A step that adds rows of ``body``, ``request_id`` and the table's columns, to the ``WrittenTable`` named ``into``.

    Its result is the number of rows that the request has added. Steps after it see the table with them.
    """

    body: Body
    into: str


Step = Rows | Count | Insert


@dataclass(frozen=True)
class Calls:
    """What a run gives, in one form for results of every size.

    ``calls``: one row per request, ``request_id, attributes, route, error,
    duration_ms, pieces, bytes``; the duration is NULL on failure.
    ``contents``: ``request_id, piece, content``; the document of a request is
    its contents joined in order of ``piece``, which starts at 0 and rises,
    perhaps with gaps. A document of up to ``piece_bytes`` is one piece.
    """

    calls: DataFrame
    contents: DataFrame


@dataclass(frozen=True)
class Procedure:
    """Arguments, steps, and outputs by index.

    An output is a function giving a column from a DataFrame that has the
    argument columns and ``rows_1``, ``rows_2``, ..., the row counts of the steps.
    """

    arguments: list[Argument] = field(default_factory=list)
    steps: list[Step] = field(default_factory=list)
    outputs: dict[int, Callable[[DataFrame], Column]] = field(default_factory=dict)


def single_request(spark: SparkSession) -> DataFrame:
    """The one request of a call without input."""
    return spark.range(1).select(
        F.col("id").alias("request_id"), F.create_map().cast("map<string,string>").alias("attributes")
    )


def run_statement(
    spark: SparkSession, text: str, properties: dict[str, str], tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Run one SQL statement with positional parameters taken from component properties.

    Tables are named in braces in the text. Only the one row of parameter
    values comes to the driver.
    """
    if not text or not text.strip():
        raise ValueError("statement is blank")
    request = with_parameters(single_request(spark), properties)
    given = [p for p in parameter_rows(request).orderBy("index").collect() if p["is_bound"]]
    arguments = [
        Argument(p["index"], f"p{p['index']}", SPARK_TYPES.get(p["jdbc_type"], "string")) for p in given if not p["error"]
    ]
    outputs = {i for i in range(1, 1 + max([p["index"] for p in given], default=0))}
    with_columns(text, [a.name for a in arguments])
    bound = bind_arguments(request, arguments, outputs).first()
    if bound["error"]:
        raise ValueError(bound["error"])
    return spark.sql(text, args=[bound[a.name] for a in arguments], **(tables or {}))


def bind_requests(
    requests: DataFrame, procedure: Procedure, properties: dict[str, str] | None = None
) -> DataFrame:
    """Requests with their parameters, typed arguments and the reason for refusing them, if any.

    Binding costs far more than reading a request, so requests are dealt out first: as many tasks take part as
    there are shuffle partitions, however few files or row groups the requests lie in.
    """
    tasks = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = requests.repartition(tasks, "request_id")
    return bind_arguments(
        with_parameters(dealt, properties), procedure.arguments, set(procedure.outputs)
    )


def _evaluate(body: Body, calls: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    if callable(body):
        return body(calls, tables)
    return calls.sparkSession.sql(body, calls=calls, **tables)


def row_json(df: DataFrame, columns: list[str], epoch_timestamps: bool = False) -> Column:
    """One row as a JSON object, NULLs written, fields in column order."""
    if not columns:
        raise ValueError("a result has no columns")
    if len(set(columns)) != len(columns):
        raise ValueError("a result has two columns of the same name")
    types = {f.name: f.dataType for f in df.schema}

    def cell(name: str) -> Column:
        value = F.col(f"`{name}`")
        if epoch_timestamps and isinstance(types[name], (TimestampType, TimestampNTZType)):
            value = F.unix_millis(value.cast("timestamp"))
        return value.alias(name)

    return F.to_json(F.struct(*[cell(c) for c in columns]), {"ignoreNullFields": "false"})


def result_rows(
    step: Rows, calls: DataFrame, tables: dict[str, DataFrame], epoch_timestamps: bool = False
) -> DataFrame:
    """``request_id, place, row``: the rows of one step as JSON, with their sort key."""
    df = _evaluate(step.body, calls, tables)
    columns = [c for c in df.columns if c != "request_id"]
    place = F.struct(*step.order_by) if step.order_by else F.struct(F.lit(0).alias("none"))
    text = row_json(df, columns, epoch_timestamps)
    return df.select("request_id", place.alias("place"), text.alias("row"))


def result_pieces(rows: DataFrame, piece_bytes: int = DEFAULT_PIECE_BYTES) -> DataFrame:
    """``request_id, part, seq, text``: stored rows of a request, in order, joined by commas into pieces.

    Rows are dealt out in ranges of request, place and row, so that a request
    takes as many tasks as its rows need, and are streamed into pieces. What
    ranges are cut by holds no text of the rows; equal places are told apart by
    the row's hash and number.
    """
    keys = ["request_id", "place", "row_hash", "row_id"]
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        rows.withColumn("row_hash", F.xxhash64("row"))
        .repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .select("request_id", "row", F.spark_partition_id().cast("bigint").alias("part"))
    )
    joined = join_runs(ordered, ["request_id"], "row", ",", 1 << 30, piece_bytes, firsts={"part": "part"}, lasts={})
    return joined.select("request_id", "part", F.col("run_seq").alias("seq"), F.col("row").alias("text"))


def step_counts(df: DataFrame) -> DataFrame:
    """``request_id, n``: changed rows per request."""
    return df.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))


def _as_declared(text: Column, code: Column, name: Column) -> Column:
    """STRUCT<json, error>: a value's text as JSON of the type that a code declares; types of text are quoted."""
    exact = text.try_cast("decimal(38,0)")
    whole = F.coalesce(exact, text.try_cast("double").try_cast("decimal(38,0)"))
    truth = F.when(F.lower(text).isin("true", "1", "1.0"), "true").when(F.lower(text).isin("false", "0", "0.0"), "false")
    floating = text.try_cast("double")
    number = F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"), text)
    json = (
        F.when(code.isin(-7, 16), truth)
        .when(code == -6, whole.try_cast("tinyint").cast("string"))
        .when(code == 5, whole.try_cast("smallint").cast("string"))
        .when(code == 4, whole.try_cast("int").cast("string"))
        .when(code == -5, whole.try_cast("bigint").cast("string"))
        .when(code.isin(6, 7, 8), json_scalar(floating))
        .when(code.isin(2, 3), number)
        .otherwise(json_scalar(text))
    )
    misfit = F.concat(F.lit("'"), text, F.lit("' is not a valid "), name)
    return F.struct(
        F.coalesce(json, F.lit("null")).alias("json"), F.when(text.isNotNull() & json.isNull(), misfit).alias("error")
    )


def output_values(outputs: dict[int, Column]) -> Column:
    """OUT and INOUT parameters in order of index: ARRAY<STRUCT<index, name, json, error>>, values in their declared types."""
    texts = F.create_map(*[x for i, c in sorted(outputs.items()) for x in (F.lit(i), c.cast("string"))])
    texts = texts if outputs else F.create_map().cast("map<int,string>")

    def value(p: Column) -> Column:
        name = F.coalesce(p["name"], F.concat(F.lit("output_"), p["index"].cast("string")))
        typed = let(F.try_element_at(texts, p["index"]), lambda t: _as_declared(t, p["jdbc_type"], p["type_name"]))
        return let(typed, lambda t: F.struct(p["index"].alias("index"), name.alias("name"), t["json"].alias("json"), t["error"].alias("error")))

    return F.transform(F.filter("parameters", lambda p: is_output(p["direction"])), value)


def outputs_json(values: Column) -> Column:
    """Output values as one JSON object; NULL without an output parameter."""
    members = F.transform(values, lambda v: F.concat(json_scalar(v["name"]), F.lit(":"), v["json"]))
    return F.when(F.size(values) > 0, F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")))


def outputs_error(values: Column) -> Column:
    """The first output that its declared type cannot hold."""
    wrong = F.filter(values, lambda v: v["error"].isNotNull())
    first = F.try_element_at(wrong, F.lit(1))
    return F.concat(F.lit("output "), first["index"].cast("string"), F.lit(": "), first["error"])


def run_statements(
    requests: DataFrame, text: str, tables: dict[str, DataFrame], arguments: list[Argument] | None = None,
    properties: dict[str, str] | None = None, order_by: list[str] | None = None, **options,
) -> Calls:
    """Run one ``?`` statement for every request, in one pass over the tables.

    Parameter i is the argument with index i; without ``arguments`` they are the inputs that ``properties`` declare. Rows of a
    request are in order of ``order_by``, columns of the result. ``options`` are those of ``run_calls``.
    """
    given = declared_arguments(properties or {}) if arguments is None else arguments
    procedure = Procedure(given, [Rows(for_all_calls(text, given), order_by or [])])
    return run_calls(requests, procedure, tables, properties, **options)


def _frames(tables: dict[str, DataFrame | WrittenTable]) -> dict[str, DataFrame]:
    """The tables as steps read them now."""
    return {name: t.rows() if isinstance(t, WrittenTable) else t for name, t in tables.items()}


def _groups(steps: list[Step]) -> list[list[tuple[int, Step]]]:
    """Steps that may run side by side: those that only read, between steps that write."""
    out: list[list[tuple[int, Step]]] = []
    for i, step in enumerate(steps, 1):
        alone = isinstance(step, Insert)
        if not out or alone or isinstance(out[-1][-1][1], Insert):
            out.append([])
        out[-1].append((i, step))
    return out


def _failed(like: DataFrame, failures: list[Failure]) -> DataFrame:
    """``request_id, reason`` of requests that failed: as many rows as runs were spent to find them."""
    schema = f"request_id {like.schema['request_id'].dataType.simpleString()}, reason string"
    first = {}
    for request_id, reason in failures:
        first.setdefault(request_id, reason)
    return like.sparkSession.createDataFrame(list(first.items()), schema)


def _run_steps(
    calls: DataFrame, procedure: Procedure, tables: dict[str, DataFrame | WrittenTable], scratch: Scratch, epoch_timestamps: bool,
    limit_millis: int | None, run: str,
) -> tuple[dict[int, DataFrame], list[Failure]]:
    """The stored results of each step, and the requests that failed; a request that failed takes no part in later groups of steps."""
    results: dict[int, DataFrame] = {}
    failures: list[Failure] = []
    for group in _groups(procedure.steps):
        frames = _frames(tables)
        live = calls.join(_failed(calls, failures).select("request_id"), "request_id", "left_anti") if failures else calls

        def one(i: int, step: Step, live=live, frames=frames) -> tuple[DataFrame, list[Failure]]:
            def stored(part: DataFrame) -> DataFrame:
                if isinstance(step, Rows):
                    rows = result_rows(step, part, frames, epoch_timestamps)
                    return scratch.written(rows.withColumn("row_id", F.monotonically_increasing_id()), f"step{i}")
                if isinstance(step, Insert):
                    counts = tables[step.into].add(part, lambda some: _evaluate(step.body, some, frames), run, i)
                else:
                    counts = step_counts(_evaluate(step.body, part, frames))
                return scratch.written(counts, f"step{i}")

            def rows(part: DataFrame) -> DataFrame:
                made = _evaluate(step.body, part, frames)
                return made.select("request_id", *tables[step.into].columns.names) if isinstance(step, Insert) else made

            # A step that counts works out no columns.
            done, failed = settle(live, stored, limit_millis, None if isinstance(step, Count) else rows)
            # Where every request failed, the empty result still has the step's columns.
            done = done or [scratch.written(stored(live.where(F.lit(False))), f"step{i}")]
            out = done[0]
            for more in done[1:]:
                out = out.unionByName(more)
            return out, failed

        jobs = [partial(one, i, step) for i, step in group]
        # With a limit one step at a time, so that none is late because of another.
        for (i, _), (result, failed) in zip(group, [j() for j in jobs] if limit_millis else side_by_side(calls.sparkSession, jobs), strict=True):
            results[i] = result
            failures += failed
    return results, failures


def run_calls(
    requests: DataFrame,
    procedure: Procedure,
    tables: dict[str, DataFrame | WrittenTable],
    properties: dict[str, str] | None = None,
    piece_bytes: int = DEFAULT_PIECE_BYTES,
    epoch_timestamps: bool = False,
    limit_millis: int | None = None,
    run: str | None = None,
) -> Calls:
    """Run a procedure for every request; see ``Calls`` for what comes back.

    A request for which a body raises fails alone, with that reason. ``limit_millis`` is the time that a step may take for one
    request: steps that take longer for many are run again for parts of them, until only requests that are late by themselves fail.

    ``run`` names the job for steps that write: a job that runs again under its name writes nothing twice.

    All documents are put together in the same way: results are joined into
    pieces, and pieces of about ``piece_bytes`` of a request are joined to the
    contents. So no request, however large its results, is gathered in one task.

    Each body runs once, into a scratch table; those are dropped when the two
    tables of the result are written to the shared folder.
    """
    started = time.monotonic()
    for step in procedure.steps:
        if isinstance(step, Insert) and not isinstance(tables.get(step.into), WrittenTable):
            raise ValueError(f"{step.into} is not a table that can be written")
    scratch = Scratch(requests.sparkSession)
    try:
        bound = scratch.written(bind_requests(requests, procedure, properties), "calls")
        accepted = bound.where(F.col("error").isNull())
        calls = accepted.select("request_id", *[a.name for a in procedure.arguments])
        results, failures = _run_steps(calls, procedure, tables, scratch, epoch_timestamps, limit_millis, run or uuid.uuid4().hex)
        error = F.col("error")
        if failures:
            failed = _failed(calls, failures)
            ids = failed.select("request_id")
            accepted = accepted.join(ids, "request_id", "left_anti")
            results = {i: r.join(ids, "request_id", "left_anti") for i, r in results.items()}
            bound, error = bound.join(failed, "request_id", "left"), F.coalesce(error, "reason")
        frame = scratch.written(_frame(accepted, procedure, results), "frame")
        if not frame.where("output_error IS NOT NULL").isEmpty():
            wrong = frame.where("output_error IS NOT NULL").select("request_id", "output_error")
            results = {i: r.join(wrong.select("request_id"), "request_id", "left_anti") for i, r in results.items()}
            bound, error = bound.join(wrong, "request_id", "left"), F.coalesce(error, "output_error")
            frame = frame.where("output_error IS NULL")
        contents = written(_contents(frame, procedure, results, piece_bytes, scratch), "contents")
        sizes = contents.groupBy("request_id").agg(
            F.count("*").alias("pieces"), F.sum(F.octet_length("content")).alias("bytes")
        )
        elapsed = F.lit(int((time.monotonic() - started) * 1000)).cast("bigint")
        done = bound.withColumn("error", error).join(sizes, "request_id", "left")
        good = F.col("error").isNull()
        done = done.select(
            "request_id", "attributes", F.when(good, SUCCESS).otherwise(FAILURE).alias("route"), "error",
            F.when(good, elapsed).alias("duration_ms"), F.coalesce("pieces", F.lit(0)).alias("pieces"),
            F.coalesce("bytes", F.lit(0)).alias("bytes"),
        )
        return Calls(written(done, "calls"), contents)
    finally:
        scratch.drop()


def run_by_statement(
    requests: DataFrame,
    procedures: dict[str, Procedure],
    tables: dict[str, DataFrame | WrittenTable],
    statement_property: str | None = None,
    properties: dict[str, str] | None = None,
    **options,
) -> Calls:
    """Run each request with the procedure its statement names; blank or unknown ones fail.

    Requests are read once and dealt by statement into parts of a stored table, of which each procedure reads its own.
    """
    spark = requests.sparkSession
    name = F.trim(statement(statement_property))
    known = F.when(name.isin(list(procedures)), name)
    refused = F.coalesce(statement_error(name), F.when(known.isNull(), F.concat(F.lit("no such procedure: "), name)))
    scratch = Scratch(spark)
    try:
        # The number of the procedure is the part's name, so that names may have any characters.
        number = F.coalesce(*[F.when(known == n, F.lit(i)) for i, n in enumerate(procedures)], F.lit(-1)).cast("int")
        chosen = requests.select("request_id", "attributes", refused.alias("error"), number.alias("procedure"))
        stored = scratch.written(chosen, "requests", ["procedure"])
        none = F.lit(0).cast("bigint")
        left = stored.where("procedure = -1").select(
            "request_id", "attributes", F.lit(FAILURE).alias("route"), "error", F.lit(None).cast("bigint").alias("duration_ms"),
            none.alias("pieces"), none.alias("bytes"),
        )
        calls, contents = written(left, "calls"), None

        def one(i: int, procedure: Procedure) -> Calls:
            mine = stored.where(F.col("procedure") == i).select("request_id", "attributes")
            return run_calls(mine, procedure, tables, properties, **options)

        jobs = [partial(one, i, p) for i, p in enumerate(procedures.values())]
        # Procedures that write, or that have a limit, do not run beside others.
        alone = options.get("limit_millis") or any(isinstance(s, Insert) for p in procedures.values() for s in p.steps)
        for done in [j() for j in jobs] if alone else side_by_side(spark, jobs):
            calls = calls.unionByName(done.calls)
            contents = done.contents if contents is None else contents.unionByName(done.contents)
        return Calls(calls, _no_contents(calls) if contents is None else contents)
    finally:
        scratch.drop()


def _no_contents(requests: DataFrame) -> DataFrame:
    piece, content = F.lit(0).cast("bigint").alias("piece"), F.lit("").alias("content")
    return requests.where(F.lit(False)).select("request_id", piece, content)


def _frame(accepted: DataFrame, procedure: Procedure, results: dict[int, DataFrame]) -> DataFrame:
    """Accepted requests with ``rows_i`` of every step and ``outputs``; step counts have one row per request."""
    out = accepted
    for i, step in enumerate(procedure.steps, 1):
        counts = step_counts(results[i]) if isinstance(step, Rows) else results[i]
        out = out.join(counts.withColumnRenamed("n", f"rows_{i}"), "request_id", "left")
        out = out.withColumn(f"rows_{i}", F.coalesce(f"rows_{i}", F.lit(0)))
    values = out.withColumn("_outputs", output_values({i: make(out) for i, make in procedure.outputs.items()}))
    json, error = outputs_json(F.col("_outputs")), outputs_error(F.col("_outputs"))
    return values.withColumns({"outputs": json, "output_error": error}).drop("_outputs")


def _marks(procedure: Procedure) -> Column:
    """What stands around the results of a request: (step, text) in order; an empty row set leaves no trace."""
    steps, seen = procedure.steps, F.lit(False)
    marks = [(0, F.lit('{"RESULTS":[' if steps else "{"))]
    for i, step in enumerate(steps, 1):
        comma = F.when(seen, ",").otherwise("")
        if not isinstance(step, Rows):
            present, text = F.lit(True), F.concat(comma, F.col(f"rows_{i}").cast("string"))
        else:
            present = F.col(f"rows_{i}") > 0
            text = F.when(present, F.concat(comma, F.lit("["))).otherwise("")
        marks.append((i, text))
        seen = seen | present
    outputs = F.concat(F.lit(',"OUTPUTS":' if steps else '"OUTPUTS":'), F.col("outputs"))
    end = F.concat(F.lit("]" if steps else ""), F.coalesce(outputs, F.lit("")), F.lit("}"))
    marks.append((len(steps) + 1, end))
    return F.array(*[F.struct(F.lit(i).alias("step"), t.alias("text")) for i, t in marks])


def document_places(pieces: DataFrame, length: Column, counted: Column) -> DataFrame:
    """Pieces (``request_id, step, part, seq`` and more) with ``before`` and ``earlier``.

    ``before`` is the length of all pieces before it in its request, ``earlier``
    how many of those of its step are ``counted``. Both are prefix sums in two
    levels: a window over the sums of the parts, then one within each part.
    """
    part = ["request_id", "step", "part"]
    sized = pieces.withColumns({"_n": length.cast("bigint"), "_c": counted.cast("bigint")})
    sums = sized.groupBy(*part).agg(F.sum("_n").alias("_part_n"), F.sum("_c").alias("_part_c"))
    starts = sums.select(
        *part,
        F.expr("sum(_part_n) OVER (PARTITION BY request_id ORDER BY step, part) - _part_n").alias("_start_n"),
        F.expr("sum(_part_c) OVER (PARTITION BY request_id, step ORDER BY part) - _part_c").alias("_start_c"),
    )
    within = "OVER (PARTITION BY request_id, step, part ORDER BY seq) "
    return sized.join(starts, part).select(
        *pieces.columns,
        F.expr(f"_start_n + sum(_n) {within} - _n").alias("before"),
        F.expr(f"_start_c + sum(_c) {within} - _c").alias("earlier"),
    )


def _contents(
    frame: DataFrame, procedure: Procedure, results: dict[int, DataFrame], piece_bytes: int, scratch: Scratch
) -> DataFrame:
    """``request_id, piece, content`` of all requests of ``frame``.

    Marks, texts of results and closing brackets are pieces with a place in the
    document. What lies before a piece is summed in two levels: over the parts of
    a document, one row each, and over the pieces within a part. Pieces that start
    in the same ``piece_bytes`` of a document are streamed into one content. So no
    task has more of a document than one range of its rows.
    """
    first, last = F.lit(-1).cast("bigint"), F.lit(1 << 62).cast("bigint")
    marks = frame.select("request_id", F.explode(_marks(procedure)).alias("m"))
    parts = marks.select("request_id", "m.step", first.alias("part"), first.alias("seq"), "m.text")
    for i, step in enumerate(procedure.steps, 1):
        if isinstance(step, Rows):
            texts = result_pieces(results[i], piece_bytes).select("request_id", F.lit(i).alias("step"), "part", "seq", "text")
            ends = results[i].select("request_id").distinct()
            closing = ends.select("request_id", F.lit(i).alias("step"), last.alias("part"), last.alias("seq"), F.lit("]").alias("text"))
            parts = parts.unionByName(texts).unionByName(closing)
    # Places depend on how ranges were cut, so they are fixed before they are used twice.
    parts = scratch.written(parts.where(F.col("text") != ""), "parts")
    is_text = F.col("seq").between(0, (1 << 62) - 1)
    placed = document_places(parts, F.octet_length("text"), is_text)
    keyed = placed.withColumn("piece", F.floor(F.col("before") / F.lit(piece_bytes)).cast("bigint"))
    # Between two pieces of one result there is a comma.
    text = F.when(is_text & (F.col("earlier") > 0), F.concat(F.lit(","), F.col("text"))).otherwise(F.col("text"))
    ordered = (
        keyed.repartition("request_id", "piece")
        .sortWithinPartitions("request_id", "piece", "step", "part", "seq")
        .select("request_id", "piece", text.alias("content"))
    )
    return join_runs(ordered, ["request_id", "piece"], "content", "", 1 << 30, 1 << 60, firsts={}, lasts={}).select(
        "request_id", "piece", "content"
    )
