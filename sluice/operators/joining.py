"""Join the texts of consecutive sorted rows under a count and a byte cap.

Each task streams its rows through Arrow and keeps no more than one Arrow batch
and one open run of joined rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def join_runs(
    ordered: DataFrame,
    keys: list[str],
    text: str,
    delimiter: str,
    max_count: int,
    max_size: int,
    firsts: dict[str, str],
    lasts: dict[str, str],
) -> DataFrame:
    """One row per run of equal keys, cut where a cap is reached.

    ``ordered`` has all rows of a key in one partition, or in a stretch of
    consecutive sorted partitions, in order. ``firsts`` and ``lasts`` name
    output columns taken from the first and last row. Adds ``record_count``,
    ``record_size`` and ``run_seq``, a number that rises within the task.
    """
    types = {f.name: f.dataType.simpleString() for f in ordered.schema}
    schema = ", ".join(
        [f"`{k}` {types[k]}" for k in keys]
        + [f"`{out}` {types[c]}" for out, c in {**firsts, **lasts}.items()]
        + ["record_count bigint", "record_size bigint", "run_seq bigint", f"`{text}` {types[text]}"]
    )
    width = len(delimiter.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: pa.Table | None = None
        seq = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            if open_rows is not None:
                rows = pa.concat_tables([open_rows, rows])
            starts = run_starts(_key_changes(rows, keys), _byte_lengths(rows[text]), width, max_count, max_size)
            # The last run may go on in the next batch; its start stays a start.
            last = int(starts[-1])
            if len(starts) > 1:
                yield _joined(rows.slice(0, last), starts[:-1], keys, text, delimiter, firsts, lasts, seq)
                seq += len(starts) - 1
            open_rows = rows.slice(last)
        if open_rows is not None:
            yield _joined(open_rows, np.zeros(1, dtype=np.int64), keys, text, delimiter, firsts, lasts, seq)

    return ordered.mapInArrow(run, schema)


def _key_changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a key differs from the row before."""
    changed = np.zeros(rows.num_rows, dtype=bool)
    changed[0] = True
    for name in keys:
        column = rows[name].combine_chunks()
        differs = pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1))
        changed[1:] |= differs.to_numpy(zero_copy_only=False)
    return changed


def _byte_lengths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)


def run_starts(changed: np.ndarray, lengths: np.ndarray, width: int, max_count: int, max_size: int) -> np.ndarray:
    """Row numbers that open a run.

    For every row the end of a run opened there follows from the running byte
    total; walking from end to end then visits just the real openings.
    """
    n = len(lengths)
    rows = np.arange(n)
    total = np.cumsum(lengths + width)
    before = total - lengths - width
    key_starts = np.flatnonzero(changed)
    key_end = np.repeat(np.append(key_starts[1:], n), np.diff(np.append(key_starts, n)))
    by_size = np.searchsorted(total, before + width + max_size, side="right")
    # The byte rule holds only once the run has bytes: up to there rows are always taken.
    if width:
        filled_at = np.where(lengths > 0, rows, rows + 1)
    else:
        filled_at = np.searchsorted(total, before, side="right")
    ends = np.minimum(np.maximum(by_size, filled_at + 1), np.minimum(rows + max_count, key_end)).tolist()
    starts = []
    row = 0
    while row < n:
        starts.append(row)
        row = ends[row]
    return np.array(starts, dtype=np.int64)


def _joined(
    rows: pa.Table,
    starts: np.ndarray,
    keys: list[str],
    text: str,
    delimiter: str,
    firsts: dict[str, str],
    lasts: dict[str, str],
    seq: int,
) -> pa.RecordBatch:
    """One output row per run of ``rows``, which start with a run and end with one."""
    ends = np.append(starts[1:], rows.num_rows)
    counts = ends - starts
    at_first, at_last = pa.array(starts), pa.array(ends - 1)
    content = rows[text].combine_chunks()
    sizes = np.add.reduceat(_byte_lengths(rows[text]), starts) + (counts - 1) * len(delimiter.encode())
    if content.null_count:
        lone_null = (counts == 1) & pc.is_null(content.take(at_first)).to_numpy(zero_copy_only=False)
        sizes[lone_null] = -1
        content = pc.fill_null(content, "" if pa.types.is_string(content.type) else b"")
    offsets = pa.array(np.append(starts, rows.num_rows).astype(np.int32))
    joined = pc.binary_join(
        pa.ListArray.from_arrays(offsets, content),
        pa.scalar(delimiter if pa.types.is_string(content.type) else delimiter.encode(), content.type),
    )
    columns = {k: rows[k].take(at_first) for k in keys}
    columns.update({out: rows[c].take(at_first) for out, c in firsts.items()})
    columns.update({out: rows[c].take(at_last) for out, c in lasts.items()})
    columns.update(
        record_count=pa.array(counts),
        record_size=pa.array(sizes),
        run_seq=pa.array(np.arange(seq, seq + len(starts))),
    )
    columns[text] = joined
    return pa.table(columns).combine_chunks().to_batches()[0]
