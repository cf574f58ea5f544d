"""Failures and time limits that stay with the requests they belong to.

A step runs for all requests at once. Where that fails, one more run finds the requests of which a
column cannot be worked out; each of these runs alone, for its own reason, and the others run together: f + 2 further runs.
Where that still fails, cannot tell, or a step takes longer than it
may, the requests are dealt by hash into parts and each part runs again, until what fails is one
request. Parts that succeed keep their results, so f failing requests of n cost
about 8 * f * log8(n) further runs, however the failing ones are spread.

What a body raises for a row of a table whatever the request, as in a condition on
the table's columns that is checked before the join, is raised in every part, so all requests fail.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from sluice.session import TimeLimitExceeded, side_by_side, time_limit

_BITS = 3
PARTS = 1 << _BITS
_CONDITION = re.compile(r"\[[A-Z][A-Z0-9_.]+\] [^\n]*")
Failure = tuple[object, str]


def reason_of(error: BaseException) -> str:
    """One line that says why a body failed: the innermost cause, without the place in the plan."""
    origin, text = getattr(error, "_origin", None), str(error)
    while origin is not None and origin.getCause() is not None:
        origin = origin.getCause()
    if origin is not None and origin.getMessage():
        text = origin.getMessage()
    found = _CONDITION.findall(text)
    line = found[-1] if found else next((x for x in text.splitlines() if x.strip()), type(error).__name__)
    return line.split(" SQLSTATE:")[0].strip()


def raising(rows: DataFrame) -> DataFrame:
    """``request_id`` of the requests that have a row of which a column cannot be worked out, found in one run.

    ``try_add`` of a date is NULL whatever its operands raise, and a hash never is. What is raised before the columns are worked
    out, as by a condition or an aggregate, is raised here too; so this is a hint only.
    """
    columns = [f"`{c}`" for c in rows.columns if c != "request_id"]
    worked_out = F.try_add(F.lit("1970-01-01").cast("date"), F.hash(*columns))
    return rows.where(worked_out.isNull()).select("request_id").distinct()


def settle(
    calls: DataFrame,
    run: Callable[[DataFrame], DataFrame],
    limit_millis: int | None = None,
    rows: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[list[DataFrame], list[Failure]]:
    """``run`` over parts of ``calls`` (``request_id`` unique): the results, and (request_id, reason) of each request that fails alone.

    ``run`` must store its result. A body that cannot be planned fails for all requests alike and is raised. With a limit
    parts run one after another, so that none is late because of others. ``rows`` gives the rows that ``run`` stores, whose columns may raise:
    with it the requests that ``raising`` finds are run alone at once, and the others together.
    """
    spark = calls.sparkSession
    done: list[DataFrame] = []
    failed: list[Failure] = []

    def attempt(part: DataFrame) -> tuple[DataFrame | None, str | None, bool]:
        try:
            with time_limit(spark, limit_millis):
                return run(part), None, False
        except (AnalysisException, ParseException):
            raise
        except TimeLimitExceeded as e:
            return None, str(e), True
        except Exception as e:  # whatever a body raises belongs to its requests
            return None, reason_of(e), False

    def each(jobs: list[Callable]) -> list[tuple[DataFrame | None, str | None, bool]]:
        return [job() for job in jobs] if limit_millis else side_by_side(spark, jobs)

    pending = [(calls, 0)]
    while pending:
        found = each([partial(attempt, part) for part, _ in pending])
        split: list[tuple[DataFrame, int]] = []
        for (part, depth), (result, reason, late) in zip(pending, found, strict=True):
            if reason is None:
                done.append(result)
                continue
            if rows is not None and not late:
                look, rows = rows, None
                suspects = _suspects(part, look, limit_millis)
                if suspects:
                    ids = _ids(part, list(suspects))
                    # Each part is made when its turn comes: there may be many.
                    ends = each([lambda r=r, part=part: attempt(_one(part, r)) for r in suspects])
                    for (request_id, times), (result, reason, _) in zip(suspects.items(), ends, strict=True):
                        if reason is None:
                            done.append(result)
                        elif times == 1:
                            failed.append((request_id, reason))
                        else:
                            split.append((_one(part, request_id), depth))
                    split.append((part.join(ids, part["request_id"].eqNullSafe(ids["request_id"]), "left_anti"), depth))
                    continue
            some = [r["request_id"] for r in part.select("request_id").limit(2).collect()]
            if len(some) == 1:
                failed.append((some[0], reason))
            elif some:
                if depth * _BITS >= 63:
                    raise RuntimeError(f"request_id is not unique: {some}")
                at = F.pmod(F.shiftright(F.xxhash64("request_id"), depth * _BITS), F.lit(PARTS))
                split += [(part.where(at == k), depth + 1) for k in range(PARTS)]
        pending = split
    return done, failed


def _one(calls: DataFrame, request_id: object) -> DataFrame:
    return calls.where(F.col("request_id").eqNullSafe(F.lit(request_id)))


def _ids(calls: DataFrame, ids: list) -> DataFrame:
    return calls.sparkSession.createDataFrame([(i,) for i in ids], f"request_id {calls.schema['request_id'].dataType.simpleString()}")


def _suspects(calls: DataFrame, rows: Callable[[DataFrame], DataFrame], limit_millis: int | None) -> dict[object, int]:
    """What ``raising`` finds, with how many calls each request has; nothing where it cannot tell. Each of them costs a run anyway."""
    if not isinstance(calls.schema["request_id"].dataType, IntegralType | StringType):
        return {}
    try:
        with time_limit(calls.sparkSession, limit_millis):
            ids = _ids(calls, [r["request_id"] for r in raising(rows(calls)).collect()])
            named = calls.join(ids, calls["request_id"].eqNullSafe(ids["request_id"]), "left_semi")
            return {r["request_id"]: r["n"] for r in named.groupBy("request_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    except Exception:  # raised where parts of the requests have to tell of whom
        return {}
