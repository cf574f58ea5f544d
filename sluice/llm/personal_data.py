"""Personal data: patterned kinds, and terms that give protected values away.

Values of four kinds (email, ip, card, phone) are protected entities. Over the
whole corpus it is counted how often a term stands near an entity, and how often each
occurs at all. A term reveals an entity as far as their pointwise mutual
information reaches the entity's own information content: a term for which that share is at or
above the disclosure threshold is generalised to its first letters, or removed
where these reveal the entity as well.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
lower case; tasks count them as 64-bit hashes. Nothing but a filter of fixed size goes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import carried, hash_pair, restored, values_of
from sluice.llm.shingles import PART, mixed
from sluice.session import written

KINDS = ("email", "ip", "card", "phone")
TERM = len(KINDS)
NAMES = (*KINDS, "term")

# Fixed patterns. A run is matched from its start only and as a whole, which gives the same matches in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile("[A-Za-z0-9\x80-\U0010ffff]+")
_DIGITS = re.compile("[0-9]")
_LOWER_TEXT = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Disclosure:
    """What counts as near, and from where on a term reveals an entity.

    Near are the closest ``terms`` terms on each side within ``chars`` characters. A term is
    judged where at least ``texts`` different texts have it near the entity, so
    that copies of one text are no evidence; it reveals the entity where their pointwise mutual information
    is at least ``share`` of the entity's information content.
    ``letters`` are kept of a generalised term.
    """

    terms: int = 10
    chars: int = 400
    texts: int = 3
    share: float = 0.9
    letters: int = 3


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        found = _DOMAIN.match(text, at + 1)
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        at += 1
        if found and start < at - 1:
            done = at = found.end()
            yield start, done


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _is_ip(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))


def _is_card(value: str) -> bool:
    digits = "".join(_DIGITS.findall(value)) if len(value) <= 40 else ""
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(value: str) -> bool:
    return 9 <= len(_DIGITS.findall(value)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points: leftmost matches of each kind that do not overlap and hold its rules."""
    out = [(0, *span) for span in _emails(text)]
    for kind, pattern, holds in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m.group())]
    return out


def entity_of(kind: int, value: str) -> bytes:
    """What stands for a protected value however it is written."""
    plain = value.lower() if kind == 0 else ".".join(p.lstrip("0") or "0" for p in value.split(".")) if kind == 1 else "".join(_DIGITS.findall(value))
    return blake2b(f"{kind}:{plain}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


_IS_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_CLASS = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Terms:
    """Terms of a text by place: hashes of each and of its first letters, and where they start and end in bytes."""

    hashes: np.ndarray
    classes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    # Code points before each byte of the text.
    points: np.ndarray


def terms_of(data: np.ndarray, letters: int) -> Terms:
    """The terms of UTF-8 bytes. A term of no more than ``letters`` characters has no class of its own (0)."""
    inside = _IS_TERM[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    leads = (data & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(leads)])
    if not len(starts):
        none = np.empty(0, dtype=np.uint64)
        return Terms(none, none, starts, ends, points)
    first = np.zeros(len(data), dtype=np.int64)
    first[starts] = starts
    place = np.arange(len(data), dtype=np.int64) - np.maximum.accumulate(first)
    values = mixed((place.astype(np.uint64) << np.uint64(8)) + _LOWER[data] + np.uint64(1))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    hashes = mixed(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))
    at = np.append(np.flatnonzero(leads), len(data))
    cut = at[np.minimum(points[starts] + letters, len(at) - 1)]
    classes = mixed((sums[np.minimum(cut, ends)] - sums[starts]) ^ _CLASS)
    classes[cut >= ends] = 0
    return Terms(hashes, classes, starts, ends, points)


def _parts(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A text's bytes in parts that are worked on at once, cut outside terms: (bytes before, part)."""
    at = 0
    while at < len(data):
        end = min(at + PART, len(data))
        while end < len(data) and _IS_TERM[data[end]]:
            end += 1
        yield at, data[at:end]
        at = end


def _bytes_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _near(text: str, start: int, end: int, spans: list[tuple[int, int, int]], rule: Disclosure) -> set[str]:
    """The terms near text[start:end], without those that are part of a protected value."""
    low, high = max(start - rule.chars, 0), min(end + rule.chars, len(text))
    blocked = [(s, e) for _, s, e in spans if s < high and e > low]

    def whole(m: re.Match) -> bool:
        """Not cut by the window's ends, and no part of a protected value."""
        cut = (m.start() == low > 0) or (m.end() == high < len(text))
        return not cut and not any(s < m.end() and m.start() < e for s, e in blocked)

    free = [m for m in _TERM.finditer(text, low, high) if whole(m)]
    chosen = [m for m in free if m.end() <= start][-rule.terms :] + [m for m in free if m.start() >= end][: rule.terms]
    return {m.group().translate(_LOWER_TEXT) for m in chosen}


_SCAN = (
    "what int, doc_id long, h1 long, h2 long, spans array<struct<kind int, start int, end int>>, "
    "entity binary, term long, class long, n long"
)
_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_SCAN_TYPES = pa.schema([
    ("what", pa.int32()), ("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("spans", _SPAN), ("entity", pa.binary()),
    ("term", pa.int64()), ("class", pa.int64()), ("n", pa.int64()),
])
# Kinds of rows of a scan.
_DOC, _PAIR, _COUNT = 0, 1, 2
# Different hashes that a task holds before it passes their counts on.
_HELD = 1 << 20


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCAN_TYPES.types)], schema=_SCAN_TYPES)


def _counts(hashes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    none = [pa.nulls(len(hashes), t) for t in _SCAN_TYPES.types]
    none[0], none[6], none[8] = pa.array(np.full(len(hashes), _COUNT, dtype=np.int32)), pa.array(hashes.view(np.int64)), pa.array(n)
    return pa.RecordBatch.from_arrays(none, schema=_SCAN_TYPES)


class _Tally:
    """How many texts have each hash; sums stay bounded, what does not fit is passed on."""

    def __init__(self) -> None:
        self.keys, self.n = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.new: list[np.ndarray] = []
        self.size = 0

    def add(self, different: np.ndarray) -> None:
        self.new.append(different)
        self.size += len(different)

    def merged(self) -> None:
        keys = np.concatenate([self.keys, *self.new])
        weights = np.concatenate([self.n, np.ones(self.size, dtype=np.int64)])
        self.keys, place = np.unique(keys, return_inverse=True)
        self.n = np.bincount(place, weights, minlength=len(self.keys)).astype(np.int64)
        self.new, self.size = [], 0

    def passed_on(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.size >= _HELD or last:
            self.merged()
        if len(self.keys) >= _HELD or (last and len(self.keys)):
            yield _counts(self.keys, self.n)
            self.keys, self.n = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)


def _one_term(term: str, letters: int) -> tuple[int, int]:
    found = terms_of(_bytes_of(term), letters)
    return int(found.hashes.view(np.int64)[0]), int(found.classes.view(np.int64)[0])


def _scan(rule: Disclosure):
    """One reading of all texts: their base spans, the terms near entities, and in how many rows each term and class is."""

    def pairs(text: str, spans: list[tuple[int, int, int]], h1: int, h2: int) -> Iterator[tuple]:
        near: dict[bytes, set[str]] = {}
        for kind, start, end in spans:
            near.setdefault(entity_of(kind, text[start:end]), set()).update(_near(text, start, end, spans, rule))
        for entity, terms in near.items():
            hashed = {_one_term(t, rule.letters) for t in terms}
            yield _PAIR, None, h1, h2, None, entity, None, None, 1
            for h, c in hashed:
                yield _PAIR, None, h1, h2, None, entity, h, c, 1
            for c in {c for _, c in hashed if c} - {h for h, _ in hashed}:
                yield _PAIR, None, h1, h2, None, entity, c, None, 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            out: list[tuple] = []
            heads = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for (doc_id, h1, h2), text in zip(heads, values_of(batch.column(3)), strict=True):
                text = text or ""
                spans = base_spans(text)
                out.append((_DOC, doc_id, h1, h2, [{"kind": k, "start": s, "end": e} for k, s, e in spans], None, None, None, None))
                if spans:
                    out += pairs(text, spans, h1, h2)
                found = [np.unique(np.concatenate([t.hashes, t.classes])) for _, part in _parts(_bytes_of(text)) for t in [terms_of(part, rule.letters)]]
                if found:
                    different = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
                    tally.add(different[different != 0])
                if len(out) >= 1 << 14:
                    yield _rows(out)
                    out = []
                yield from tally.passed_on()
            if out:
                yield _rows(out)
        yield from tally.passed_on(last=True)

    return scan


# Of keys with more than 1 / HOT_SHARE of all rows there are at most HOT_SHARE, so that those may be broadcast.
HOT_SHARE = 10_000


def _with(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join with a table of unique keys; ``weight`` is at least a key's rows in ``left``, but for a factor all keys share.

    Heavy keys, at most ``HOT_SHARE``, are broadcast; all others are shuffled.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) > total / HOT_SHARE
    hot, rest = right.where(heavy), right.where(~heavy)
    few = left.join(F.broadcast(hot), key)
    return few.unionByName(left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest.hint("merge"), key))


def revealing_terms(scanned: DataFrame, rule: Disclosure) -> DataFrame:
    """``term, n, general``: hashes of the terms that reveal an entity, their number of rows, and whether their class reveals none of these."""
    rows = scanned.where(F.col("what") == _DOC).count()
    near = scanned.where(F.col("what") == _PAIR)
    known = written(
        scanned.where(F.col("what") == _COUNT).groupBy("term").agg(F.sum("n").alias("n_term")), "pii-terms"
    )
    # Equal texts are brought together first: they count as rows, but as one text.
    by_text = near.groupBy("entity", "term", "class", "h1", "h2").agg(F.sum("n").alias("n"))
    counted = by_text.groupBy("entity", "term").agg(
        F.max("class").alias("class"), F.sum("n").alias("n_both"), F.count("*").alias("texts")
    )
    counted = written(counted.where((F.col("texts") >= rule.texts) | F.col("class").isNull()), "pii-pairs")
    pairs = counted.where("term IS NOT NULL")
    sizes = pairs.groupBy("entity").agg(F.count("*").alias("n_pairs"))
    entities = counted.where("term IS NULL").select("entity", F.col("n_both").alias("n_entity")).join(sizes.hint("merge"), "entity")
    measured = _with(_with(pairs, written(entities, "pii-entities"), "entity", "n_pairs"), known, "term", "n_term")
    content = F.log(F.lit(float(max(rows, 1))) / F.col("n_entity"))
    shared = F.log(F.col("n_both") * F.lit(float(max(rows, 1))) / (F.col("n_entity") * F.col("n_term")))
    # Rounded, so that equality with the threshold does not hang on the last bit.
    reveals = (content > 0) & (F.round(shared - F.lit(rule.share) * content, 9) >= 0)
    judged = written(measured.select("entity", "term", "class", "texts", "n_term", reveals.alias("reveals")), "pii-judged")
    found = judged.where(F.col("reveals") & F.col("class").isNotNull() & (F.col("texts") >= rule.texts))
    classes = judged.select("entity", F.col("term").alias("class"), F.col("reveals").alias("class_reveals"))
    both = found.join(classes.hint("merge"), ["entity", "class"], "left")
    safe = (F.col("class") != 0) & ~F.coalesce("class_reveals", F.lit(True))
    return both.groupBy("term").agg(F.max("n_term").alias("n"), F.bool_and(safe).alias("general"))


# Bits of the filter of revealing terms: 2 MB, whatever the corpus.
FILTER_BITS = 1 << 24


def _filter(terms: DataFrame) -> np.ndarray:
    """A bit for each revealing term; what it lets through is joined with the terms themselves."""
    bit = F.pmod("term", F.lit(FILTER_BITS))
    word = F.floor(bit / 64).cast("int")
    words = terms.select(word.alias("word"), F.expr(f"shiftleft(1L, cast(pmod(term, {FILTER_BITS}) % 64 as int))").alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


_HITS = "doc_id long, h1 long, h2 long, term long, places array<struct<start int, end int>>"
_HIT_TYPES = pa.schema([
    ("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("term", pa.int64()),
    ("places", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
])


def _hits(bits: np.ndarray, letters: int):
    """Where texts have terms that pass the filter."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            heads = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for head, text in zip(heads, values_of(batch.column(3)), strict=True):
                places: dict[int, list[dict]] = {}
                points = 0
                for _, part in _parts(_bytes_of(text)):
                    found = terms_of(part, letters)
                    for i in np.flatnonzero(bits[(found.hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64)]):
                        start, end = (points + int(found.points[x[i]]) for x in (found.starts, found.ends))
                        places.setdefault(int(found.hashes[i : i + 1].view(np.int64)[0]), []).append({"start": start, "end": end})
                    points += int(found.points[-1])
                out += [(*head, term, at) for term, at in places.items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _HIT_TYPES.types)], schema=_HIT_TYPES)

    return hits


KEYS = ["doc_id", "h1", "h2"]


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by id, NULL being one, and hash of the text."""
    there = right.withColumnsRenamed({k: f"r_{k}" for k in KEYS})
    on = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in KEYS]
    return left.join(there.hint("merge"), on, how).drop(*[f"r_{k}" for k in KEYS])


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Disclosure | None = None) -> DataFrame:
    """``doc_id, h1, h2, base, terms`` of every row: spans in code points, end exclusive; ``h1, h2`` are the text's hash.

    ``base`` has ``kind`` (its place in ``KINDS``), ``start``, ``end``, by kind and start; ``terms`` has ``start``, ``end``
    and ``general``, by start, without those that overlap a base span.

    A NULL text is empty. Ids may be NULL or repeat; equal rows have equal
    spans. A text that repeats is no evidence that a term reveals anything. An empty table gives no rows.
    Further columns have no effect.
    """
    rule = rule or Disclosure()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *hash_pair(text), text.alias("text"))
    scanned = written(slim.mapInArrow(_scan(rule), _SCAN), "pii-scan")
    terms = written(revealing_terms(scanned, rule), "pii-revealing")
    rows = scanned.where(F.col("what") == _DOC)
    # Equal rows are one until the end, so that no key has more than one row.
    different = rows.groupBy(*KEYS).agg(F.first("spans").alias("base"), F.count("*").alias("copies"))
    hits = written(slim.mapInArrow(_hits(_filter(terms), rule.letters), _HITS), "pii-hits").dropDuplicates([*KEYS, "term"])
    sure = _with(hits, terms, "term", "n").select(*KEYS, F.explode("places").alias("at"), "general")
    spans = sure.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("at.start", "at.end", "general"))).alias("found"))
    joined = _same(different, spans, "left")
    none = F.array().cast("array<struct<start int, end int, general boolean>>")
    free = F.filter(
        F.coalesce("found", none), lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    out = joined.select(*KEYS, "base", F.when(F.size("base") == 0, F.coalesce("found", none)).otherwise(free).alias("terms"), "copies")
    return _repeated(out)


def _repeated(rows: DataFrame, most: int = 1 << 16) -> DataFrame:
    """Each row as often as ``copies`` says, by lists of bounded length."""
    lists = F.explode(F.sequence(F.lit(0), ((F.col("copies") - 1) / most).cast("long")))
    dealt = rows.withColumn("list", lists)
    here = F.least(F.lit(most), F.col("copies") - F.col("list") * most).cast("int")
    return dealt.withColumn("copy", F.explode(F.array_repeat(F.lit(0), here))).drop("copies", "list", "copy")


def kind_count(spans: Column, kind: int) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_text(spans: Column, kind: Column | None = None) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(n) for n in NAMES])

    def one(s: Column) -> Column:
        name = F.element_at(names, s["kind"] + 1) if kind is None else kind
        return F.concat_ws(":", name, s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Disclosure | None = None) -> DataFrame:
    """The documents with all their columns; base values are replaced by their kind, revealing terms by their
    first letters and ``*``, or removed.

    Of overlapping base values the one that starts first, or else the longer one, names the replacement of what both cover. A NULL text
    stays NULL. Odd rows are treated as ``personal_spans`` says.
    """
    rule = rule or Disclosure()
    place = docs.columns.index(text_col)
    found = personal_spans(docs, id_col, text_col, rule).dropDuplicates(KEYS)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*carried(docs), F.col(f"`{id_col}`").cast("long").alias("doc_id"), *hash_pair(text))
    joined = _same(rows, found.where((F.size("base") > 0) | (F.size("terms") > 0)), "left")
    replace = F.udf(lambda t, base, terms: replaced(t, base, terms, rule.letters), "string", useArrow=True)
    changed = replace(f"in_{place}", "base", "terms")
    return joined.withColumn(f"in_{place}", changed).select(*restored(docs.columns))


def replaced(text: str | None, base, terms, letters: int) -> str | None:
    """A text with its spans replaced."""
    if text is None or base is None:
        return text
    spans = [(s["start"], -s["end"], f"<{KINDS[s['kind']]}>") for s in base]
    spans += [(t["start"], -t["end"], text[t["start"] : t["start"] + letters] + "*" if t["general"] else "") for t in terms]
    out, at = [], 0
    for start, end, new in sorted(spans):
        if start >= at:
            out += [text[at:start], new]
        at = max(at, -end)
    return "".join([*out, text[at:]])
