"""Documents to training data: stages over the operators of ``sluice.llm``.

A stage is ``(spark, docs, sf_dir) -> DataFrame``. Its result is written and
read again before the next one, so a lost executor costs one stage's tasks at
most. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, line_dedup, mixing, ngram_join, quality
from sluice.llm.catalog import vocabulary
from sluice.llm.common import table
from sluice.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR = ngram_join.Alike(size=5, percent=80)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_quality(docs).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without long lines that five or more share; ``n_chars`` is that of what is left."""
    kept = line_dedup.without_shared_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by sets of five-word shingles that are 0.8 alike, the one with the smallest id.

    Documents without words are alike to none. Equal rows with one id are one
    document; rows without an id stay if no row of their group has one.
    """
    found = ngram_join.join_ngrams(docs, rule=NEAR)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("stays")).distinct()
    kept = docs.join(stays, F.col("doc_id").eqNullSafe(F.col("stays")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the domains want them."""
    return mixing.mix_documents(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document."""
    return bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", keep_quality), ("line_dedup", drop_lines), ("ngram_join", keep_one), ("mixing", mix), ("bpe", encode)]
# Several stages have no SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
