"""Mixing documents to target weights of domains that are known only for labelled ones.

A classifier over hashed words, counted from a labelled table, gives every
document its domain posteriors. Rates per document, not below zero, are fitted
by projected gradient steps so that expected tokens of each domain meet its target, or come as close as any
rates can. All documents take part; Spark sums what a step needs, the driver sees a few numbers for each domain.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import carried, restored, values_of
from sluice.llm.shingles import hashed_words
from sluice.session import written

LOG = logging.getLogger(__name__)

DOMAINS = ("clean", "low", "toxic")
# Production targets: shares of all tokens.
WEIGHTS = (0.995, 0.005, 0.0)
# Words are hashed to so many features; ratios of characters and words, in steps, follow them.
WORD_FEATURES, STEPS = 1 << 18, 8
FEATURES = WORD_FEATURES + 4 * STEPS
# A feature's share of a domain is drawn to the overall share with the weight of so many documents.
SHRINK = 5.0

_PLAIN = np.frombuffer(bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)), dtype=np.uint8)
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"]] = True


def features(text: str | None) -> tuple[np.ndarray, int]:
    """The different features of a text, and its number of words: runs of letters and digits, or of bytes beyond ASCII."""
    raw = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
    words = hashed_words(_PLAIN[raw])
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.int64), 0
    different = np.unique(words)
    ratios = (_MARK[raw].sum() / n, _UPPER[raw].sum() / n, (words[1:] == words[:-1]).sum() / n, 1 - len(different) / n)
    steps = [int(np.searchsorted((0.001, 0.02, 0.05, 0.1, 0.3, 0.6, 1.0), r)) for r in ratios]
    shapes = WORD_FEATURES + STEPS * np.arange(4) + np.array(steps)
    return np.concatenate([np.unique(different >> np.uint64(46)).astype(np.int64), shapes]), n


# A feature's log odds count fully where its share is many standard deviations from the overall one, and half at so many.
HALF = 2.0
# Scores, log odds, fall into these classes, and numbers of different features into those.
EDGES, LENGTHS = (-40.0, -20.0, -10.0, -5.0, -2.0, 0.0, 2.0, 5.0, 10.0, 20.0, 40.0), (32, 100, 320, 1000)


def _cell(scores: np.ndarray, length: int) -> int:
    """The class of a document's scores against the first domain and its length.

    Up to three domains have a class for each combination of score classes. With more, whose combinations
    grow too many, the class is that of the best and the next domain and of how far these are apart.
    """
    out = int(np.searchsorted(LENGTHS, length))
    if len(scores) <= 2:
        for step in np.searchsorted(EDGES, scores).tolist():
            out = out * (len(EDGES) + 1) + step
        return out
    full = np.concatenate([[0.0], scores])
    last, best = np.argsort(full, kind="stable")[-2:].tolist()
    apart = int(np.searchsorted(EDGES, full[best] - full[last]))
    return ((out * len(full) + best) * len(full) + last) * (len(EDGES) + 1) + apart


def _cells(domains: int) -> int:
    """The number of classes."""
    return (len(LENGTHS) + 1) * (len(EDGES) + 1) ** (domains - 1) if domains <= 3 else (len(LENGTHS) + 1) * domains**2 * (len(EDGES) + 1)


@dataclass(frozen=True)
class Classifier:
    """Posteriors by classes of scores and lengths.

    ``weights`` has for each feature and each domain but the first the log odds
    against the first, shrunken by how sure they are; a document's scores are their sums and the overall log odds.
    ``table`` has the posteriors that labelled documents with scores and lengths of the same classes had,
    the last row those of all.
    """

    weights: np.ndarray
    prior: np.ndarray
    table: np.ndarray

    def posteriors(self, found: np.ndarray) -> np.ndarray:
        if not len(found):
            return self.table[-1]
        return self.table[_cell(self.prior + self.weights[found].sum(axis=0), len(found))]


def _weights(seen: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shrunken log odds of features (a row of counts of documents by domain each) against the first domain."""
    n, there = seen.sum(axis=1, keepdims=True), np.where(share > 0, share, 1.0)
    odds = np.log((seen + SHRINK * there) / (n + SHRINK) / there)
    z2 = (seen - n * share) ** 2 / (n * share * (1 - share) + 1)
    odds = np.where(share > 0, odds * z2 / (z2 + HALF**2), 0.0)
    return odds[:, 1:] - odds[:, :1]


def _table(cells: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Posteriors of each class, drawn to those of its scores at any length, which are drawn to the overall share."""
    by_length = cells.reshape(len(LENGTHS) + 1, -1, cells.shape[1])
    scores = by_length.sum(axis=0)
    scores = (scores + share) / (scores.sum(axis=1, keepdims=True) + 1)
    p = (by_length + SHRINK * scores) / (by_length.sum(axis=2, keepdims=True) + SHRINK)
    return np.concatenate([p.reshape(cells.shape), share[None, :]])


def domain_of(labels: DataFrame) -> Column:
    """0 clean, 1 low, 2 toxic; NULL where a label lacks a value."""
    return F.when(F.col("toxic") == 1, 2).when((F.col("toxic") == 0) & (F.col("quality") == 0), 1).when(
        (F.col("toxic") == 0) & (F.col("quality") == 1), 0
    )


def _summed(rows: DataFrame, count, height: int, wide: int) -> np.ndarray:
    """Sums over all rows of what ``count(domain, features)`` names: a table of ``height`` times ``wide`` at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, wide), dtype=np.int64)
        for batch in batches:
            lists = batch.column(1)
            flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, domain in enumerate(batch.column(0).to_pylist()):
                total[count(domain, flat[at[i] : at[i + 1]])] += 1
        row, column = np.nonzero(total)
        columns = [pa.array(row, pa.int32()), pa.array(column, pa.int32()), pa.array(total[row, column])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "n"])

    out = np.zeros((height, wide))
    summed = rows.mapInArrow(counted, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))
    sums = summed.toArrow()
    out[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["n"].to_numpy()
    return out


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: int = len(DOMAINS)) -> Classifier:
    """From all documents (doc_id, text) that ``labelled`` (doc_id, domain) names; without any, all are of domain 0.

    Labels with a NULL id or domain, and labels without a document, have no effect; a NULL or empty text has no words.
    A document or a label that repeats counts as often as the two meet.
    """
    known = labelled.where("domain IS NOT NULL").select(F.col("doc_id").alias("label_id"), "domain")
    # Labels are as many as documents, so both are shuffled whatever their size.
    joined = docs.join(known.hint("merge"), F.col("doc_id") == F.col("label_id")).select("domain", "text")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [features(t)[0].astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], ["domain", "features"])

    rows = written(joined.mapInArrow(found, "domain int, features array<int>"), "labelled")
    counts = np.zeros(domains)
    for r in rows.groupBy("domain").count().collect():
        counts[r["domain"]] = r["count"]
    if not counts.sum():
        counts[0] = 1.0
    share = counts / counts.sum()
    seen = np.ascontiguousarray(_summed(rows, lambda domain, f: (domain, f), domains, FEATURES).T)
    odds = np.log(np.where(share > 0, share, 1.0))
    prior = odds[1:] - odds[0]

    def apart(domain: int, f: np.ndarray) -> tuple[int, int]:
        """A labelled document is scored by the counts of the others, as documents without a label are."""
        others = seen[f]
        others[:, domain] -= 1
        return _cell(prior + _weights(others, share).sum(axis=0), len(f)), domain

    cells = _summed(rows.where(F.size("features") > 0), apart, _cells(domains), domains)
    return Classifier(_weights(seen, share), prior, _table(cells, share))


def score_documents(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id, n_tokens, p`` of every row, with ``carry`` also its columns by place, as ``row.in_0`` and so on.

    A NULL or empty text has no tokens and the overall posteriors. Ids may be NULL or repeat; columns may have any names.
    """
    columns = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")]
    slim = docs.select(*columns, *([F.struct(*carried(docs)).alias("row")] if carry else []))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))])
    for f in slim.schema.fields[2:]:
        schema.add(f)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in values_of(batch.column(1))]
            p = [classifier.posteriors(f).tolist() for f, _ in found]
            made = [batch.column(0), pa.array([n for _, n in found], pa.int64()), pa.array(p, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*made, *batch.columns[2:]], ["doc_id", "n_tokens", "p", *(["row"] if carry else [])])

    return slim.mapInArrow(scored, schema)


@dataclass(frozen=True)
class Step:
    """One projected step: rates move against ``p @ along`` by ``length``, those near zero against ``p @ pull``, and never below zero."""

    along: np.ndarray
    pull: np.ndarray
    near: float
    length: float


def _direction(step: Step, p: np.ndarray, rate: np.ndarray) -> np.ndarray:
    pull = p @ step.pull
    held = (rate <= step.near) & (pull > 0)
    return -np.where(held, pull, p @ step.along)


def rates_of(steps: list[Step], p: np.ndarray) -> np.ndarray:
    """The rates of rows with posteriors ``p`` after all steps, from 1 on: what a row gets depends on its posteriors only."""
    rate = np.ones(len(p))
    for step in steps:
        rate = np.maximum(0.0, rate + step.length * _direction(step, p, rate))
    return rate


@dataclass(frozen=True)
class Fit:
    """The steps that were taken, and where they led.

    ``totals`` are the expected tokens of each domain at these rates. ``gap``
    bounds how far, as a share of all target tokens, totals are from those of the least-squares optimum.
    """

    steps: list[Step]
    totals: tuple[float, ...]
    target: tuple[float, ...]
    gap: float

    @property
    def residual(self) -> tuple[float, ...]:
        """Expected less target tokens of each domain."""
        return tuple(t - w for t, w in zip(self.totals, self.target, strict=True))

    def missed(self, tolerance: float = 1e-3) -> list[int]:
        """The domains whose target no rates can meet together with the others'."""
        return [k for k, r in enumerate(self.residual) if abs(r) > tolerance * max(sum(self.target), 1.0)]


def _rate(fit: Fit) -> Column:
    steps = fit.steps

    @F.pandas_udf("double")
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(rates_of(steps, np.stack(p.to_numpy())) if len(p) else [])

    return rate("p")


# Lengths of a step that are tried at once.
LENGTHS_TRIED = tuple((0.5 ** np.arange(14)).tolist())


def _sums(classes: DataFrame, values, width: int) -> np.ndarray:
    """The sum over all classes (p, n) of what ``values(p, n)``, rows of ``width``, has; the last column is a minimum.

    Each task sends its sums, so that the many passes of a fit need no shuffle.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, least = np.zeros(width), np.inf
        for batch in batches:
            if batch.num_rows:
                found, low = values(np.stack(batch.column(0).to_numpy(zero_copy_only=False)), batch.column(1).to_numpy().astype(float))
                total, least = total + found, min(least, low)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total), pa.array(np.full(width, least))], ["i", "x", "low"])

    got = classes.select("p", "n").mapInArrow(summed, "i int, x double, low double").toArrow()
    out = np.zeros(width + 1)
    np.add.at(out, got["i"].to_numpy(), got["x"].to_numpy())
    out[width] = min(got["low"].to_pylist(), default=np.inf)
    return out


def fit_rates(scored: DataFrame, weights: tuple[float, ...] = WEIGHTS, tolerance: float = 1e-3) -> Fit:
    """Rates whose expected domain totals meet the targets, or come closest to them.

    The first domain with a weight sets the scale: it keeps its expected tokens. Least squares over relative errors
    by projected gradient steps, all sums of which Spark takes over (posteriors, tokens): a first pass gives
    totals, the moments of rates that are free to move and the least pull, from which the driver has the direction (for free rates the gradient
    scaled by those moments, for rates held at zero the plain one); a second one gives totals at many step lengths, of which
    the longest that lowers the squares enough is taken. What is kept is the list of steps, a few numbers for each domain;
    tasks follow them anew. It ends when the gap to the optimum is proven to be
    within ``tolerance``, or when no step lowers the squares by more than a billionth of their start.
    """
    k = len(weights)
    # One row for each posterior vector that the classifier has, of which there are as many as its classes.
    classes = scored.where("n_tokens > 0").groupBy("p").agg(F.sum("n_tokens").cast("double").alias("n"))
    classes = written(classes, "rate-classes")
    base = _sums(classes, lambda p, n: (n @ p, np.inf), k)[:k]
    every = max(base.sum(), 1.0)
    scale = next((b / w for b, w in zip(base, weights, strict=True) if w > 0 and b > 0), 0.0)
    target = scale * np.array(weights)
    there = base > 0
    if not there.any():
        return Fit([], tuple(base.tolist()), tuple(target.tolist()), 0.0)
    # In shares of all tokens; domains that no document may be of have no say.
    share, want = base / every, np.where(there, target / every, 0.0)
    by = np.where(there, 1 / np.where(there, share, 1.0), 0.0)
    most = np.sqrt((want**2 * by).sum())
    steps: list[Step] = []

    def squares(z: np.ndarray) -> np.ndarray:
        return 0.5 * ((z - want) ** 2 * by).sum(axis=-1)

    z, gap, first = share, np.inf, float(squares(share))
    while True:
        pull = (z - want) * by

        def moments(p: np.ndarray, n: np.ndarray, done=tuple(steps), pull=pull) -> tuple[np.ndarray, float]:
            rate, against = rates_of(done, p), p @ pull
            moved = rate - np.maximum(0.0, rate - against)
            free = ~((rate <= 0) & (against > 0))
            return np.concatenate([[n @ moved**2], ((p[free] * n[free, None]).T @ p[free]).ravel()]) / every, float(against.min())

        found = _sums(classes, moments, 1 + k * k)
        least = found[-1]
        excess = max(0.0, float(pull @ z) + max(0.0, -least) * most)
        gap = float(np.sqrt(2 * excess * share.max())) / max(want.sum(), 1e-300)
        if gap <= tolerance:
            break
        near, gram = max(1e-12, min(0.1, float(np.sqrt(found[0])))), found[1:-1].reshape(k, k)
        curve = gram @ (by[:, None] * gram) + 1e-12 * np.trace(gram) * gram
        along = np.linalg.lstsq(curve, gram @ pull, rcond=1e-14)[0]
        # The scaled direction and, for where that one leads nowhere, the plain gradient.
        curb = max(float(np.trace(gram @ np.diag(by))), 1e-300)
        trials = [Step(along, pull, near, length) for length in LENGTHS_TRIED]
        trials += [Step(pull, pull, 0.0, length / curb) for length in LENGTHS_TRIED]

        def tried(p: np.ndarray, n: np.ndarray, done=tuple(steps), trials=tuple(trials)) -> tuple[np.ndarray, float]:
            rate, out = rates_of(done, p), []
            against = p @ trials[0].pull
            ways = {step.near: _direction(step, p, rate) for step in (trials[0], trials[-1])}
            for step in trials:
                moved = np.maximum(0.0, rate + step.length * ways[step.near])
                out.append(np.concatenate([(n * moved) @ p, [-(n * against) @ (moved - rate)]]))
            return np.concatenate(out) / every, np.inf

        rows = _sums(classes, tried, len(trials) * (k + 1))[:-1].reshape(-1, k + 1)
        lower = float(squares(z)) - squares(rows[:, :k])
        good = np.flatnonzero((lower >= 0.1 * rows[:, k]) & (rows[:, k] > 0))
        if not len(good) or lower[good[0]] <= 1e-9 * max(first, 1e-300):
            break
        steps.append(trials[good[0]])
        z = rows[good[0], :k]
    fit = Fit(steps, tuple((z * every).tolist()), tuple(target.tolist()), gap)
    for i in fit.missed():
        LOG.warning("domain %d: %.0f expected tokens, target %.0f; no rates meet all targets", i, fit.totals[i], fit.target[i])
    return fit


def _copies(rate: Column) -> Column:
    """A whole number whose expectation over documents is the rate; a function of the id."""
    chance = (F.pmod(F.xxhash64(F.lit("copies"), F.coalesce("doc_id", F.lit(-1))), F.lit(1 << 20)) + 0.5) / float(1 << 20)
    return F.floor(rate + chance).cast("int")


def rate_and_fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: tuple[float, ...] = WEIGHTS,
    carry: bool = False,
) -> tuple[DataFrame, Fit]:
    """``rate_documents`` with the fit, which has the residual of each domain."""
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    classifier = fit_classifier(slim, labels.select("doc_id", domain_of(labels).alias("domain")))
    # Posteriors stay with their rows, so that each text is scored once.
    scored = written(score_documents(docs, classifier, id_col, text_col, carry), "posteriors")
    fit = fit_rates(scored, weights)
    return scored.withColumn("rate", _rate(fit)).withColumn("copies", _copies(F.col("rate"))), fit


def rate_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: tuple[float, ...] = WEIGHTS,
    carry: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, p, rate, copies`` of every row, with ``carry`` also ``row``.

    ``labels`` has ``doc_id, quality, toxic``; labels without a value or
    without a document have no effect. A NULL or empty text has no tokens and
    the overall posteriors. Ids may be NULL or repeat: such rows get the same number of copies.
    """
    return rate_and_fit(docs, labels, id_col, text_col, weights, carry)[0]


def mix_documents(docs: DataFrame, labels: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The documents, each as often as its copies say, with all their columns, whatever their names.

    Odd rows are treated as ``rate_documents`` says. An empty table stays empty.
    """
    rated = rate_documents(docs, labels, weights=weights, carry=True).where("copies > 0")
    each = rated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return each.select("row.*").select(*restored(docs.columns))
