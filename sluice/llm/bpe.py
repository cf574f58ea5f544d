"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one token is the last of the prefix's
encoding. A suffix automaton of all tokens, built once from the vocabulary,
gives the tokens that end a prefix, in one walk over the word. Of these the one
is kept that is compatible with the last token of what is before it. Two tokens
are compatible if no merge would join pieces of both before they are whole.
Back-pointers from the whole word give the ids.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import pretokens as P
from sluice.llm.suffix_automaton import SuffixAutomaton

NEVER = 1 << 62
# Token pairs whose compatibility a worker remembers.
SEEN = 500_000
# Fixed value: the mark of a word's end in the vocabulary file.
WORD_END = "</w>"
# A symbol at a word's end is moved to this place, so that each symbol is one character.
END_PLANE = 0xE000


class WordBpe:
    """The vocabulary of a word-end BPE file, and the encoding of single words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or model["byte_fallback"]:
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.content = {i: t for t, i in {**model["vocab"], **self.specials}.items()}
        symbols = P.byte_symbols()
        self.inner = [symbols[b] for b in range(256)]
        self.last = [chr(END_PLANE + ord(symbols[b])) for b in range(256)]
        self.ids = {self._packed(t): i for t, i in model["vocab"].items()}
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.made_at: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, whole = (self.ids[self._packed(t)] for t in (a, b, a + b))
            if whole in self.parts:
                raise ValueError("a token is made by two merges")
            if max(self.made_at.get(left, -1), self.made_at.get(right, -1)) >= rank:
                raise ValueError("a merge uses a token made later")
            self.pair_rank[left, right], self.made_at[whole], self.parts[whole] = rank, rank, (left, right)
        self.pairs: dict[int, bool] = {}
        self.automaton = SuffixAutomaton((text, i) for text, i in self.ids.items() if self._reachable(i))

    @staticmethod
    def _packed(token: str) -> str:
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            body = token[: -len(WORD_END)]
            return body[:-1] + chr(END_PLANE + ord(body[-1]))
        return token

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token, smallest first, each with the rank of the merge that ends it."""
        out = [(token, NEVER)]
        while token in self.parts:
            rank, token = self.made_at[token], self.parts[token][side]
            out.append((token, rank))
        return out[::-1]

    def _joined_at(self, left: int, right: int) -> int:
        """The rank of the first merge of a piece of ``left`` with one of ``right``; NEVER if there is none."""
        # Edges are short and pairs are remembered, so edges are not kept.
        a, b, i, j = self._edge(left, 1), self._edge(right, 0), 0, 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.pair_rank.get((x, y), NEVER)
            # Of equal merges the leftmost is done first: one within ``left`` comes before this, one within ``right`` after.
            if rank < x_ends and rank <= y_ends and rank != NEVER:
                return rank
            if x_ends == y_ends == NEVER:
                return NEVER
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def _reachable(self, token: int) -> bool:
        """Whether the token's own text is encoded as this token."""
        return token not in self.parts or self._joined_at(*self.parts[token]) == self.made_at[token]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > SEEN:
                self.pairs = {}
            known = self.pairs[key] = self._joined_at(left, right) == NEVER
        return known

    def encode_word(self, word: str) -> np.ndarray:
        """The ids of one pre-token."""
        data = word.encode("utf-8", "surrogatepass")
        text = "".join([self.inner[b] for b in data[:-1]]) + self.last[data[-1]]
        n = len(text)
        token, length, pairs = [-1] * n, [0] * n, self.pairs
        for end, i, size in self.automaton.matches(text):
            if token[end] >= 0:
                continue
            before = end - size
            if before >= 0:
                left = token[before]
                if left < 0:
                    continue
                fits = pairs.get(left << 32 | i)
                if not (self.compatible(left, i) if fits is None else fits):
                    continue
            token[end], length[end] = i, size
        out, at = [], n - 1
        while at >= 0:
            out.append(token[at])
            at -= length[at]
        return np.array(out[::-1], dtype=np.uint32)

    def decode(self, ids: list[int]) -> str:
        """The tokens' own texts, joined by spaces: the file names no decoder."""
        return " ".join(map(self.content.__getitem__, ids))


def normal(text: str) -> str:
    """NFC, then lower case of each code point by itself (white space only separates, so its kind does not matter)."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


class Encoder(P.TextEncoder):
    """Encodes batches of texts as the vocabulary file says."""

    def __init__(self, path: str):
        self.words = WordBpe(path)
        super().__init__(self.words.specials, normal, P.word_spans, lambda strings: map(self.words.encode_word, strings))

    def forget(self) -> None:
        """Let go of what was remembered; an idle worker keeps the vocabulary only."""
        super().forget()
        self.words.pairs = {}


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; with ``digests`` also ``ids_sha256`` and ``decoded_sha256`` in place of ``ids``.

    Special tokens written out in a text become their ids. A NULL or empty text
    has no ids. Ids of documents may be NULL or repeat; rows are independent of
    each other, in any order. ``path`` is the vocabulary file, on every machine.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(path)
        try:
            for batch in batches:
                for at, texts in P.column_parts(batch.column(1), 4 * P.CHUNK):
                    found = list(work.encode(texts))
                    sizes = [len(x) for x in found]
                    columns = [batch.column(0).slice(at, len(texts)), pa.array(sizes, pa.int64())]
                    if digests:
                        columns.append(pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found]))
                        decoded = (work.words.decode(x.tolist()) for x in found)
                        columns.append(pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in decoded]))
                    else:
                        flat = pa.array(np.concatenate(found).astype(np.int32), pa.int32())
                        columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), flat))
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            work.forget()

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids"])]
    schema = "doc_id bigint, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>")
    return slim.mapInArrow(encoded, schema)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; no ids, or NULL, give the empty text."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path).words
        for batch in batches:
            texts = [words.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id bigint, text string")
