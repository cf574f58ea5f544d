"""Call requests: attributes to typed parameters.

A request is one row ``request_id, attributes MAP<STRING, STRING>``. All
parameter work is done inside the row, so none of it shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import casts as C
from sluice.functions.temporal import is_blank, let

# Names of attributes and routes.
TYPE_NAME = r"^procedure\.args\.(in|out|inout)\.([0-9]+)\.type$"
STATEMENT = "stored.procedure.statement"
SUCCESS, FAILURE = "success", "failure"

# Type codes and names.
TYPE_CODES = {
    -7: "BIT", -6: "TINYINT", 5: "SMALLINT", 4: "INTEGER", -5: "BIGINT", 6: "FLOAT", 7: "REAL", 8: "DOUBLE",
    2: "NUMERIC", 3: "DECIMAL", 1: "CHAR", 12: "VARCHAR", -1: "LONGVARCHAR", 91: "DATE", 92: "TIME",
    93: "TIMESTAMP", -2: "BINARY", -3: "VARBINARY", -4: "LONGVARBINARY", 0: "NULL", 1111: "OTHER",
    2000: "JAVA_OBJECT", 2001: "DISTINCT", 2002: "STRUCT", 2003: "ARRAY", 2004: "BLOB", 2005: "CLOB",
    2006: "REF", 70: "DATALINK", 16: "BOOLEAN", -8: "ROWID", -15: "NCHAR", -9: "NVARCHAR",
    -16: "LONGNVARCHAR", 2011: "NCLOB", 2009: "SQLXML", 2012: "REF_CURSOR", 2013: "TIME_WITH_TIMEZONE",
    2014: "TIMESTAMP_WITH_TIMEZONE",
}


# Spark types that values of a code are bound as; other codes are text.
SPARK_TYPES = {
    -7: "boolean", 16: "boolean", -6: "tinyint", 5: "smallint", 4: "int", -5: "bigint", 7: "float", 6: "double",
    8: "double", 3: f"decimal(38,{C.DECIMAL_SCALE})", 2: f"decimal(38,{C.DECIMAL_SCALE})", 91: "date", 92: "bigint",
    93: "timestamp", -2: "binary", -3: "binary", -4: "binary",
}


@dataclass(frozen=True)
class Argument:
    """A parameter that a procedure declares: its index, column name and Spark type."""

    index: int
    name: str
    spark_type: str
    required: bool = True


def direction(text: Column) -> Column:
    """``in``, ``out`` or ``inout`` from text in any case; NULL for anything else."""
    return F.when(F.lower(text).isin("in", "out", "inout"), F.lower(text))


def type_name(code: Column) -> Column:
    """Name of a type code; NULL for an unknown one. The table is part of the expression."""
    pairs = ", ".join(f"{c}, '{name}'" for c, name in TYPE_CODES.items())
    return F.try_element_at(F.expr(f"map({pairs})"), code)


def is_input(direction: Column) -> Column:
    return direction.isin("in", "inout")


def is_output(direction: Column) -> Column:
    return direction.isin("out", "inout")


def _entries(attributes: Column) -> Column:
    """One struct per ``.type`` attribute, in name order, with its sibling attributes."""
    names = F.sort_array(F.filter(F.map_keys(attributes), lambda n: n.rlike(TYPE_NAME)))

    def entry(name: Column) -> Column:
        way = F.regexp_extract(name, TYPE_NAME, 1)
        digits = F.regexp_extract(name, TYPE_NAME, 2)
        number = digits.try_cast("int")
        code_text = F.try_element_at(attributes, name)
        code = F.when(code_text.rlike(r"^[+-]?[0-9]+$"), code_text.try_cast("int"))

        def sibling(part: str) -> Column:
            # An index with leading zeros names the same parameter with or without them.
            spelled = [F.concat(F.lit("procedure.args."), way, F.lit("."), d, F.lit(f".{part}")) for d in
                       (digits, number.cast("string"))]
            return F.coalesce(*[F.try_element_at(attributes, s) for s in spelled])

        takes, gives = is_input(way), is_output(way)
        return F.struct(
            number.alias("index"),
            direction(way).alias("direction"),
            code.alias("jdbc_type"),
            F.when(takes, sibling("value")).alias("value"),
            F.when(takes, sibling("format")).alias("format"),
            F.when(gives, let(sibling("name"), lambda n: F.when(~is_blank(n), n))).alias("name"),
            F.when(number.isNull(), F.concat(F.lit("bad index in "), name))
            .when(code.isNull(), F.concat(F.lit("type is not a number: "), F.coalesce(code_text, F.lit("null"))))
            .when(type_name(code).isNull(), F.concat(F.lit("unknown type code "), code.cast("string")))
            .alias("error"),
        )

    return F.transform(names, entry)


def _merge(entries: Column) -> Column:
    """One parameter per index, later entries overriding earlier ones field by field."""

    def last(group: Column, field: str) -> Column:
        return F.try_element_at(F.filter(group[field], lambda v: v.isNotNull()), F.lit(-1))

    def parameter(index: Column) -> Column:
        def build(group: Column) -> Column:
            newest = F.element_at(group, -1)

            def field(name: str) -> Column:
                """The only entry's field, or the last one that is there."""
                return F.when(F.size(group) == 1, newest[name]).otherwise(last(group, name))

            first_error = F.try_element_at(F.filter(group["error"], lambda e: e.isNotNull()), F.lit(1))
            return F.struct(
                index.alias("index"),
                newest["direction"].alias("direction"),
                newest["jdbc_type"].alias("jdbc_type"),
                type_name(newest["jdbc_type"]).alias("type_name"),
                field("value").alias("value"),
                field("format").alias("format"),
                field("name").alias("name"),
                F.when(F.size(group) == 1, newest["error"]).otherwise(first_error).alias("error"),
            )

        return let(F.filter(entries, lambda e: e["index"].eqNullSafe(index)), build)

    return F.transform(F.sort_array(F.array_distinct(entries["index"])), parameter)


def with_parameters(requests: DataFrame, properties: dict[str, str] | None = None) -> DataFrame:
    """Add ``parameters``: component properties first, overridden by request attributes.

    A later type and direction always override; a value or format only when it
    is there, a name only when it is not blank. A request that does not repeat
    ``.type`` overrides nothing.
    """
    own = F.create_map(*[F.lit(x) for pair in (properties or {}).items() for x in pair]).cast("map<string,string>")
    staged = requests.withColumn("_entries", F.concat(_entries(own), _entries(_or_empty(F.col("attributes")))))
    return staged.withColumn("parameters", _merge(F.col("_entries"))).drop("_entries")


def _or_empty(attributes: Column) -> Column:
    return F.coalesce(attributes, F.create_map().cast("map<string,string>"))


def parameter_rows(requests: DataFrame) -> DataFrame:
    """One row per parameter of each request."""
    # The outer form keeps the optimizer from working out the array again to filter out empty ones.
    rows = requests.select("request_id", F.explode_outer("parameters").alias("p"))
    return rows.where(F.col("p").isNotNull()).select(
        "request_id",
        "p.*",
        is_input(F.col("p.direction")).alias("is_bound"),
        is_output(F.col("p.direction")).alias("is_output"),
    )


def statement(property_text: str | None = None) -> Column:
    """Statement of a request: the component property wins over the attribute."""
    if property_text is not None:
        return F.lit(property_text)
    return F.try_element_at(_or_empty(F.col("attributes")), F.lit(STATEMENT))


def statement_error(text: Column) -> Column:
    """Reason to refuse a blank statement."""
    return F.when(is_blank(text), F.lit("statement is blank"))


BINARY_CODES = (-2, -3, -4)


def check_value(parameter: Column) -> Column:
    """STRUCT<value, error>: the text after strict conversion by the declared type code.

    The value is again text, in the one form that every type of Spark reads
    back; bytes are base64.
    """
    text, fmt, code = parameter["value"], parameter["format"], parameter["jdbc_type"]

    def as_text(cast: Column, render=lambda v: v.cast("string")) -> Column:
        return let(cast, lambda c: F.struct(render(c["value"]).alias("value"), c["error"].alias("error")))

    return (
        F.when(code == -7, as_text(C.cast_bit(text)))
        .when(code == 16, as_text(C.cast_boolean(text)))
        .when(code == -6, as_text(C.cast_integer(text, "tinyint")))
        .when(code == 5, as_text(C.cast_integer(text, "smallint")))
        .when(code == 4, as_text(C.cast_integer(text, "int")))
        .when(code == -5, as_text(C.cast_integer(text, "bigint")))
        .when(code == 7, as_text(C.cast_floating(text, "float")))
        .when(code.isin(6, 8), as_text(C.cast_floating(text, "double")))
        .when(code.isin(2, 3), C.decimal_text(text))
        .when(code.isin(91, 92, 93), C.cast_temporal_text(text, fmt, code))
        .when(code.isin(*BINARY_CODES), as_text(C.cast_binary(text, fmt), F.base64))
        .otherwise(C.cast_text(text))
    )


def _unchanged(text: Column, value: Column, spark_type: str) -> Column:
    """The converted value, or NULL where the type holds another number than the text says."""
    if spark_type.startswith("decimal"):
        scale = int(spark_type.rstrip(") ").rpartition(",")[2]) if "," in spark_type else 0
        return F.when(C.decimal_places(text) <= scale, value)
    if spark_type in ("float", "double"):
        # So few digits are always kept; of more the type must print the same number. Hexadecimal texts have no such digits.
        kept, least = (6, 1e-37) if spark_type == "float" else (15, 1e-307)

        def exact(d: Column) -> Column:
            few = (F.length(d["digits"]) <= kept) & ((F.abs(value) >= least) | (d["digits"] == ""))
            return few | (d == C.digits_of(value.cast("string")))

        named = text.rlike("Infinity|NaN")
        infinite = F.abs(value) == float("inf")
        return F.when(named | (~infinite & F.coalesce(let(C.digits_of(text), exact), F.lit(True))), value)
    return value


def _bind_one(argument: Argument) -> Column:
    """STRUCT<value, error> of one argument, from the checked inputs."""
    missing = F.lit("is not given" if argument.required else None).cast("string")

    def bind(p: Column) -> Column:
        text = p["checked"]["value"]
        if argument.spark_type == "binary":
            value = F.when(p["jdbc_type"].isin(*BINARY_CODES), F.unbase64(text)).otherwise(text.cast("binary"))
        elif argument.spark_type in C.INTEGER_TYPES:
            # Text of a decimal or floating type is taken when it is a whole number.
            exact = text.try_cast(f"decimal(38,{C.DECIMAL_SCALE})")
            whole = F.when(exact == F.floor(exact), exact.try_cast(argument.spark_type))
            value = F.coalesce(text.try_cast(argument.spark_type), whole)
        else:
            value = _unchanged(text, text.try_cast(argument.spark_type), argument.spark_type)
        misfit = F.concat(F.lit("'"), text, F.lit(f"' cannot be used as {argument.spark_type}"))
        error = (
            F.when(p.isNull(), missing)
            .when(p["checked"]["error"].isNotNull(), p["checked"]["error"])
            .when(text.isNotNull() & value.isNull(), misfit)
        )
        return F.struct(value.alias("value"), error.alias("error"))

    mine = F.filter(F.col("_inputs"), lambda p: p["index"] == argument.index)
    return let(F.try_element_at(mine, F.lit(1)), bind)


def bind_arguments(requests: DataFrame, arguments: list[Argument], outputs: set[int] = frozenset()) -> DataFrame:
    """Add one typed column per argument, and ``error`` with the first reason to fail.

    Indexes that the procedure neither takes nor returns, inputs that are not
    given and texts that do not convert are errors; a given NULL is not.
    """
    by_index = {a.index: a for a in arguments}
    if len(by_index) != len(arguments):
        raise ValueError("two arguments have the same index")
    known = sorted({*by_index, *outputs})

    def problem(p: Column) -> Column:
        where = F.concat(F.lit("parameter "), F.coalesce(p["index"].cast("string"), F.lit("?")), F.lit(": "))
        taken = F.array(*[F.lit(i) for i in sorted(by_index)]).cast("array<int>")
        given = F.array(*[F.lit(i) for i in sorted(outputs)]).cast("array<int>")
        reason = (
            F.when(p["error"].isNotNull(), p["error"])
            .when(~p["index"].isin(known), F.lit("no such parameter"))
            .when(is_input(p["direction"]) & ~F.array_contains(taken, p["index"]), F.lit("is not an input"))
            .when(is_output(p["direction"]) & ~F.array_contains(given, p["index"]), F.lit("is not an output"))
        )
        return F.concat(where, reason)

    reasons = F.filter(F.transform(F.col("parameters"), problem), lambda r: r.isNotNull())
    # Checked once for all parameters, so the plan does not grow with the number of arguments.
    inputs = F.transform(
        F.filter("parameters", lambda p: is_input(p["direction"])),
        lambda p: F.struct(p["index"], p["jdbc_type"], check_value(p).alias("checked")),
    )
    staged = requests.withColumns({"_refused": F.try_element_at(reasons, F.lit(1)), "_inputs": inputs})
    checks = [F.col("_refused")]
    bound = {}
    for a in arguments:
        bound[f"_bound_{a.index}"] = _bind_one(a)
        checks.append(F.concat(F.lit(f"parameter {a.index}: "), F.col(f"_bound_{a.index}")["error"]))
    staged = staged.withColumns(bound)
    return staged.withColumns(
        {a.name: F.col(f"_bound_{a.index}")["value"] for a in arguments} | {"error": F.coalesce(*checks)}
    ).drop("_refused", "_inputs", *bound)
