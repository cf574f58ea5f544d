"""SQL statements with positional parameters, for one request or for a whole table of them."""

from __future__ import annotations

import re

from sluice.operators.parameters import SPARK_TYPES, TYPE_NAME, Argument

# What a question mark inside is no parameter: quoted text, quoted names and comments.
_TOKENS = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/|\?""", re.S)
CALL, RESULT = "_call", "_result"


def with_columns(text: str, columns: list[str]) -> str:
    """The statement with its i-th ``?`` replaced by the i-th text; there must be as many of both."""
    found = 0

    def replaced(match: re.Match) -> str:
        nonlocal found
        if match.group() != "?":
            return match.group()
        found += 1
        return columns[found - 1] if found <= len(columns) else "?"

    out = _TOKENS.sub(replaced, text)
    if found != len(columns):
        raise ValueError(f"the statement has {found} parameters, {len(columns)} are given")
    return out


def for_all_calls(text: str, arguments: list[Argument]) -> str:
    """A step's text that runs a ``?`` statement for every row of ``{calls}``, as a lateral join.

    Parameter i is the argument with index i. What the statement compares with a
    parameter for equality becomes a key of the join, so one pass over the tables serves all
    requests; a statement without such a comparison, and an aggregate over a parameter's range, compares every request with every row.
    """
    if not text or not text.strip():
        raise ValueError("statement is blank")
    by_index = {a.index: a for a in arguments}
    if sorted(by_index) != list(range(1, len(arguments) + 1)):
        raise ValueError("parameters must be numbered from 1 on without gaps")
    columns = [f"{CALL}.`{by_index[i].name}`" for i in range(1, len(arguments) + 1)]
    inner = with_columns(text.strip().rstrip(";"), columns)
    # The line's end closes a comment that the statement may end with.
    return f"SELECT {CALL}.request_id, {RESULT}.* FROM {{calls}} AS {CALL}, LATERAL ({inner}\n) AS {RESULT}"


def declared_arguments(properties: dict[str, str]) -> list[Argument]:
    """The inputs that component properties declare, in order of index, with the type of their code."""
    out = {}
    for name, code in properties.items():
        found = re.fullmatch(TYPE_NAME.strip("^$"), name)
        if found and found.group(1) in ("in", "inout"):
            index = int(found.group(2))
            out[index] = Argument(index, f"p{index}", SPARK_TYPES.get(int(code), "string"))
    return [out[i] for i in sorted(out)]
