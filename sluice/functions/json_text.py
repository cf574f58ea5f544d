"""JSON text without a schema: canonical form, envelope, scalar rendering."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions.json_tokens import compact_json
from sluice.functions.temporal import let


def _last_key_wins(text: str | None) -> str | None:
    """Drop all but the last of equal keys, keeping the first one's place; NULL for what is not JSON."""
    if text is None:
        return None
    try:
        return compact_json(text)
    except ValueError:
        return None


@F.arrow_udf(StringType())
def _repair_duplicates(texts: pa.Array) -> pa.Array:
    if texts.null_count == len(texts):
        return texts
    return pa.array(map(_last_key_wins, texts.to_pylist()), pa.string())


def strict_json(value: Column) -> Column:
    """Compact JSON text of any shape, key order kept; malformed text and equal keys give NULL.

    ``get_json_object`` minifies, but it also takes single-quoted names and
    keeps equal keys; ``try_parse_json`` is strict on both.
    """
    text = value.cast("string")
    compact = F.get_json_object(text, "$")
    # A top-level string comes back without its quotes.
    quoted = F.when(text.rlike(r'^\s*"'), json_scalar(compact)).otherwise(compact)
    return F.when(F.try_parse_json(text).isNotNull(), quoted)


def repaired_json(value: Column, strict: Column) -> Column:
    """``strict``, or for a text it refused: the same with the last of equal keys, and without limits of length and depth.

    Only refused texts are looked at in Python. What is within the limits of the JVM's
    parser goes through it once more, so that numbers have its form; what is beyond them stays as
    it was read. ``strict`` should be a column of its own.
    """
    refused = F.when(strict.isNull(), F.make_valid_utf8(value.cast("string")))
    return let(_repair_duplicates(refused), lambda t: F.coalesce(strict, F.get_json_object(t, "$"), t))


def canonical_json(value: Column, duplicate_keys: str = "last") -> Column:
    """Compact JSON text of any shape, key order kept; malformed text gives NULL.

    Of equal keys the last one wins, or the text is refused and nothing leaves
    the JVM (``duplicate_keys="reject"``).
    """
    if duplicate_keys not in ("last", "reject"):
        raise ValueError("duplicate_keys must be 'last' or 'reject'")
    strict = strict_json(value)
    return strict if duplicate_keys == "reject" else repaired_json(value, strict)


def json_scalar(value: Column) -> Column:
    """The JSON text of one value; NULL becomes ``null``."""
    wrapped = F.to_json(F.array(value))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def envelope(key_json: Column, value_json: Column) -> Column:
    """``{"key":K,"value":V}``; a NULL part is left out, both NULL give ``{}``."""
    return F.concat(
        F.lit("{"),
        F.concat_ws(",", F.concat(F.lit('"key":'), key_json), F.concat(F.lit('"value":'), value_json)),
        F.lit("}"),
    )
