"""Line dedup over levelled sorted runs of line hashes.

Documents are taken in batches, largest ids first. A batch's line keys are
counted, merge-joined against the runs written before (a key that no run has is
fresh, and its largest id is the document that keeps the line), and written as
a run of its own. ``fanout`` runs of one level are merged into one of the next.
Runs are tables bucketed and sorted by line hash, so that joins against them
and merges of them move no rows of the runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import SPACE, carried, fixed, hash_pair, id_cuts, lower_ascii, restored, width
from sluice.session import delete_folder, save_table, stored, written

KEYS = ["h1", "h2"]
# A key in more than 1 / HOT_SHARE of all (document, line) pairs is hot; there are at most HOT_SHARE such keys.
HOT_SHARE = 10_000


def line_key(line: Column) -> Column:
    """What equal lines share: no white space at the ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2): the long line keys of each row, once per row."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.char_length(k) >= min_chars))
    return docs.select("doc_id", F.explode(keys).alias("key")).select("doc_id", *hash_pair(F.col("key")))


class LineRuns:
    """Sorted runs (h1, h2, n_docs, holder) in levels; every batch adds one run."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout, self.buckets = spark, fanout, width(spark)
        self.levels: list[list[str]] = []
        # Tables that were begun and are not dropped yet, in levels or not.
        self.written: list[str] = []
        self.folders: dict[str, str] = {}

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.written.append(name)
        self.folders[name] = save_table(df.write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS), self.spark, name)
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def fresh(self, counted: DataFrame) -> DataFrame:
        """``counted`` with ``is_fresh``: no run has the key."""
        known = []
        for i, name in enumerate(self.runs()):
            known.append(f"known_{i}")
            run = self.spark.table(name).select(*KEYS, F.lit(True).alias(known[-1]))
            counted = counted.join(run.hint("merge"), KEYS, "left")
        is_fresh = F.coalesce(*[F.col(k) for k in known], F.lit(False)) == F.lit(False)
        return counted.withColumn("is_fresh", is_fresh).drop(*known)

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (doc_id, h1, h2); every document lies in one batch, larger ids in earlier ones."""
        counted = keys.groupBy(*KEYS).agg(
            F.count_distinct(F.struct("doc_id")).alias("n_docs"), F.max("doc_id").alias("largest")
        )
        own = self.fresh(counted).select(*KEYS, "n_docs", F.when(F.col("is_fresh"), F.col("largest")).alias("holder"))
        self._place(0, self._write(own))

    def _place(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            names, self.levels[level] = self.levels[level], []
            self._place(level + 1, self._merged(names))

    def _merged(self, names: list[str]) -> str:
        """One run from several: a merge of sorted buckets."""
        out = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).withColumnsRenamed({"n_docs": "n_more", "holder": "holder_more"})
            out = out.join(more.hint("merge"), KEYS, "full_outer").select(
                *KEYS,
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_more", F.lit(0))).alias("n_docs"),
                F.coalesce("holder", "holder_more").alias("holder"),
            )
        merged = self._write(out)
        self.drop(names)
        return merged

    def compacted(self) -> DataFrame:
        """All runs as one."""
        names = self.runs()
        if len(names) > 1:
            self.levels = [[self._merged(names)]]
        return self.spark.table(self.runs()[0])

    def drop(self, names: list[str]) -> None:
        for name in list(names):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            if name in self.folders:
                delete_folder(self.spark, self.folders.pop(name))
            self.written.remove(name)


def _batches(keys: DataFrame, count: int) -> list[DataFrame]:
    """Ranges of ids, largest first; the last also takes rows without an id. The cuts only balance the batches."""
    at, upper = F.col("doc_id"), [None, *reversed(id_cuts(keys, "doc_id", count))]
    out = []
    for high, low in zip(upper, [*upper[1:], None], strict=True):
        rule = F.lit(True) if high is None else at <= high
        out.append(keys.where(rule & (at > low)) if low is not None else keys.where(rule | at.isNull()))
    return out


def dropped_lines(keys: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """(doc_id, drops): the keys each document loses.

    Hot keys, at most ``HOT_SHARE`` by their share of all pairs, are broadcast;
    all others are joined by shuffling, where no key has more than that share.
    """
    pairs = index.agg(F.sum("n_docs")).first()[0] or 0
    common = index.where(F.col("n_docs") >= min_docs)
    is_hot = F.col("n_docs") > pairs / HOT_SHARE
    hot, rest = common.where(is_hot).select(*KEYS, "holder"), common.where(~is_hot).select(*KEYS, "holder")
    lost = ~F.col("doc_id").eqNullSafe(F.col("holder"))
    few = keys.join(F.broadcast(hot), KEYS).where(lost)
    others = keys.join(F.broadcast(hot.select(*KEYS)), KEYS, "left_anti").join(rest, KEYS).where(lost)
    return few.unionByName(others).groupBy("doc_id").agg(F.collect_set(F.struct(*KEYS)).alias("drops"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
    batches: int = 4, fanout: int = 3, carry: bool = False,
) -> DataFrame:
    """Documents without lines that many share; only the largest id that has a line keeps it.

    Line keys of at least ``min_chars`` code points found in at least
    ``min_docs`` documents go. Returns ``doc_id``, ``n_lines``, ``n_dropped``
    and ``kept_text``, with ``carry`` also the input's columns as ``in_0``,
    ``in_1`` and so on. A NULL or empty text is one
    empty line. Rows that repeat an id are one document; rows without an id are
    one document that comes last. An empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = docs.select(*carried(docs), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) if carry else slim
    # Hashes are stored once: batches and the last join read them and not the texts again.
    keys, folder = stored(document_keys(slim, min_chars), "line-keys")
    runs = LineRuns(docs.sparkSession, fanout)
    try:
        for batch in _batches(keys, batches):
            runs.add(batch)
        drops = written(dropped_lines(keys, runs.compacted(), min_docs), "line-drops")
    finally:
        runs.drop(runs.written)
        delete_folder(docs.sparkSession, folder)
    # One plan at every size: the keys to drop grow with the documents, so both sides are shuffled.
    drops = drops.withColumnRenamed("doc_id", "drop_id").hint("merge")
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")), "left").drop("drop_id")
    split = fixed(joined, "lines", lines_of(F.col("text"))).drop("text")

    def stays(line: Column) -> Column:
        key = line_key(line)
        return (F.char_length(key) < min_chars) | ~F.array_contains(F.col("drops"), F.struct(*hash_pair(key)))

    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.filter("lines", stays))
    return fixed(split, "kept", kept).select(
        *[c for c in split.columns if c.startswith("in_")],
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept_text"),
    )


def without_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, their texts without the lines that many share.

    A NULL text becomes an empty one; odd rows are treated as ``dedup_lines`` says. Columns may have any names.
    """
    kept = dedup_lines(docs, id_col, text_col, carry=True).withColumn(f"in_{docs.columns.index(text_col)}", F.col("kept_text"))
    return kept.select(*restored(docs.columns))
