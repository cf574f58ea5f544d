"""Small helpers that the operators of this subpackage share.

Every operator takes the names of the columns it needs and selects only those,
so further columns of its input, whatever their names, have no effect.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words: space and the control characters 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: what hot groups are split into grows with it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_pair(value: Column, first: str = "h1", second: str = "h2") -> list[Column]:
    """128 bits that stand for a text: two chained 64-bit hashes."""
    return [F.xxhash64(value).alias(first), F.xxhash64(F.lit("second"), value).alias(second)]


def lower_ascii(value: Column) -> Column:
    return F.translate(value, UPPER, LOWER)


def carried(docs: DataFrame) -> list[Column]:
    """All columns of an input, named by place: such names clash with none."""
    return [F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)]


def restored(names: list[str]) -> list[Column]:
    """The carried columns under their own names."""
    return [F.col(f"in_{i}").alias(n) for i, n in enumerate(names)]


def rows_frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A frame of few driver rows, also when there are none."""
    return spark.createDataFrame(rows, schema)


def spread_join(many: DataFrame, few: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """``many`` with the one row that ``few`` has for its keys, where any share of the rows may have the same keys.

    Rows of equal keys are dealt out by the hash of ``by``, into as many pieces
    as the session has shuffle partitions; each piece that occurs looks its keys
    up once, so no task gets more of one key than a row for each piece.
    """
    piece = F.pmod(F.xxhash64(by), F.lit(width(many.sparkSession))).alias("_piece")
    found = many.select(*keys, piece).distinct().join(few, keys)
    return many.select("*", piece).join(found, [*keys, "_piece"], how).drop("_piece")


def fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once, however often later expressions use it.

    The optimizer merges plain projections and so would write ``value`` into
    each of its uses; it keeps a generator, here of one row, as it is.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def id_cuts(df: DataFrame, column: str, count: int) -> list[int]:
    """Rising values that cut a column into about ``count`` parts of near equal size; they only balance work."""
    if count < 2:
        return []
    return sorted({int(q) for q in df.approxQuantile(column, [i / count for i in range(1, count)], 0.2 / count)})


def cut_number(cuts: list, key: Column, low: int = 0) -> Column:
    """How many of the rising cuts lie below a key: a binary search as an expression."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(key <= cuts[mid], cut_number(cuts[:mid], key, low)).otherwise(cut_number(cuts[mid + 1 :], key, low + mid + 1))


def values_of(column, rows: int = 256) -> Iterator:
    """The values of an Arrow column in turn, few of them in memory as Python objects."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()
