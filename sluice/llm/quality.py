"""Quality rules: a table of thresholds compiled into one Spark projection.

Only DataFrame functions are used; a document's verdict needs its own row only,
so there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SPACE, UPPER, carried, fixed, lower_ascii, restored

WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Frequent function words of these four languages; parameters of ``quality_signals``.
STOP_LANGS = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the of and to in is that it was for on are as with his they at be this have from or had by "
    "der die das und den von zu mit sich des ist im nicht ein eine auf für dem "
    "le la les de des et un une que qui dans est pour avec par pas du ou au il "
    "el los las en y que del se por con una su para al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep documents whose ``signal`` lies in [least, most]; a missing bound is open, a missing signal passes."""

    signal: str
    least: float | None = None
    most: float | None = None

    def passed(self) -> Column:
        value = F.col(self.signal)
        bounds = [value >= b for b in [self.least] if b is not None] + [value <= b for b in [self.most] if b is not None]
        out = F.lit(True)
        for b in bounds:
            out = out & F.coalesce(b, F.lit(True))
        return out


# Production thresholds. Ratios are taken per document; see ``quality_signals`` for the signals.
RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", most=0.05),
    Rule("stop_word_ratio", least=0.04),
    Rule("dup_line_ratio", most=0.4),
    Rule("bullet_line_ratio", most=0.9),
    Rule("upper_ratio", most=0.6),
)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare != "", F.split(bare, "[ \\t-\\r]+")).otherwise(F.array().cast("array<string>"))


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _from(array: str, place: int) -> Column:
    """The rest of an array from a place (1 is the first) on."""
    return F.slice(array, F.lit(place), F.lit(2**30))


def _places(placed: str) -> Column:
    """Of sorted (hash, place) pairs, the sorted places whose hash is not alone; one may come twice."""
    none = F.array().cast("array<int>")
    pairs = F.zip_with(
        placed, _from(placed, 2), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(none)
    )
    return F.sort_array(F.flatten(pairs))


def quality_signals(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stop_words=STOP_WORDS, carry: bool = False,
    lang_col: str = "lang", stop_langs=STOP_LANGS,
) -> DataFrame:
    """One row per row of ``docs``: the id, base counts, and the ratios that rules refer to.

    With ``carry`` the input's columns follow as ``in_0``, ``in_1`` and so on.

    A NULL or empty text counts as one without words. Ratios without a
    denominator are NULL and pass every rule; so is the ratio of stop words
    where ``lang_col`` names none of the languages that the words are of. Without such a column all rows have it. Ids may be NULL or repeat; equal
    rows get equal signals; an empty table gives none.
    """
    stops = [F.lit(w) for w in sorted(set(stop_words))]
    text = F.coalesce(F.col(text_col), F.lit(""))
    more = [f"in_{i}" for i in range(len(docs.columns))] if carry else []
    # ``en`` of ``en-US``.
    lang = lower_ascii(F.substring_index(F.substring_index(F.col(lang_col).cast("string"), "-", 1), "_", 1)) if lang_col in docs.columns else None
    listed = F.lit(True) if lang is None else F.coalesce(lang.isin(*stop_langs), F.lit(False))
    base = docs.select(*(carried(docs) if carry else []), F.col(id_col).alias("doc_id"), text.alias("text"), listed.alias("listed"))
    with_words = base.select(
        *more,
        "doc_id",
        "listed",
        "text",
        words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"),
        F.translate("text", SPACE, "").alias("packed"),
    )
    # Hashes of 1, 2, 4 and 8 words: each stage pairs the one before with itself, moved by that many words.
    hashed = fixed(with_words, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        pairs = F.zip_with("hashes", _from("hashes", step + 1), lambda a, b: F.xxhash64(a, b))
        hashed = fixed(hashed, "hashes", pairs)
    windows = F.slice("hashes", F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    counted = hashed.select(
        *more,
        "doc_id",
        "listed",
        F.size("words").cast("long").alias("n_words"),
        F.char_length("packed").cast("long").alias("word_chars"),
        (F.char_length("packed") - _without(F.col("packed"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: F.ltrim(x).rlike("^[-*•|]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("words", lambda w: lower_ascii(w).isin(*stops))).cast("long").alias("n_stop_words"),
        (F.char_length("packed") - _without(F.col("packed"), UPPER)).cast("long").alias("n_upper"),
        windows.alias("windows"),
    )
    # Sorting is left to rows that have repeats.
    counted = fixed(counted, "windows", F.col("windows"))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    counted = fixed(counted, "placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed))
    repeats = fixed(counted, "places", F.when(F.col("placed").isNotNull(), _places("placed")))
    covered = F.aggregate(
        F.zip_with("places", _from("places", 2), lambda a, b: F.least(b - a, F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    n = F.nullif(F.col("n_words"), F.lit(0)).cast("double")
    chars, lines = F.nullif(F.col("word_chars"), F.lit(0)).cast("double"), F.nullif(F.col("n_lines"), F.lit(0)).cast("double")
    return repeats.select(
        *more, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("places").isNull(), F.lit(0).cast("long")).otherwise(covered).alias("n_repeat_words"),
        (F.col("word_chars") / n).alias("mean_word_chars"),
        (F.col("n_symbols") / chars).alias("symbol_ratio"),
        F.when(F.col("listed"), F.col("n_stop_words") / n).alias("stop_word_ratio"),
        (F.col("n_dup_lines") / lines).alias("dup_line_ratio"),
        (F.col("n_bullet_lines") / lines).alias("bullet_line_ratio"),
        (F.col("n_upper") / chars).alias("upper_ratio"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def verdict(rules=RULES) -> Column:
    """The table of rules as one expression."""
    out = F.lit(True)
    for rule in rules:
        out = out & rule.passed()
    return out


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, carry: bool = False
) -> DataFrame:
    """Signals of every document with ``base_failed`` and ``kept``."""
    signals = quality_signals(docs, id_col, text_col, carry=carry)
    return signals.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """The documents that pass, with all their columns."""
    return judge_quality(docs, id_col, text_col, rules, carry=True).where("kept").select(*restored(docs.columns))
