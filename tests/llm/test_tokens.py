import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import bpe, pretokens, token_files
from sluice.llm.catalog import op3_bpe, op10_token_files
from sluice.llm.suffix_automaton import SuffixAutomaton

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
EDGES = [
    "", "a", "'s", "it's 'start x''s !'s 're'veil 12 a1b2  x", "ΑΣ ΣΑΣ İI", "é <|endoftext|>hi<|startoftext|>",
    "\x1c a\x85b c", "日本語 text 😀😀 ok", "aaaa aaaaaaa aaaaaaaaaaa", "İ'll we'll", "ﬁ Å ①²", "x​y", "!!!'s?",
    "a" * 5000, "'" * 9 + "s", "\n\n 'd", "  two  spaces\n\n\nthree \t tabs\t", " 's 't", "end ", "end \n", "\n", " ", "I'LL i'll'll",
]


@pytest.fixture(scope="module")
def texts(spark, sf):
    return EDGES + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


@pytest.mark.parametrize("seed", range(30))
def test_suffix_automaton_finds_every_word(seed):
    rnd = random.Random(seed)

    def string(most):
        return "".join(rnd.choice("abc"[: 1 + seed % 3]) for _ in range(rnd.randint(1, most)))

    words = {string(7): i for i in range(rnd.randint(0, 40))}
    automaton = SuffixAutomaton(words.items())
    for text in ["", "x", *[string(40) + rnd.choice(["", "x"]) + string(9) for _ in range(20)]]:
        want = [(e, words[text[b : e + 1]], e + 1 - b) for e in range(len(text)) for b in range(e + 1) if text[b : e + 1] in words]
        assert list(automaton.matches(text)) == want
    assert list(SuffixAutomaton([]).matches("abc")) == []
    assert list(SuffixAutomaton([("", 3), ("a", 1), ("a", 2)]).matches("ba")) == [(1, 2, 1)]


def test_words_as_the_library(texts):
    lib, own = Tokenizer.from_file(WORDS), bpe.encoder(WORDS)
    for text, ids, want in zip(texts, own.encode(texts), lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids, text[:60]
        assert own.words.decode(want.ids) == lib.decode(want.ids, skip_special_tokens=False)


def test_bytes_as_the_library(texts):
    lib, own = Tokenizer.from_file(BYTES), token_files.encoder(BYTES)
    for text, ids, want in zip(texts, own.encode(texts), lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids, text[:60]


def test_long_texts_are_cut_where_it_changes_nothing(monkeypatch, texts):
    want = [x.tolist() for x in bpe.Encoder(WORDS).encode(texts)]
    monkeypatch.setattr(pretokens, "CHUNK", 50)
    own = bpe.Encoder(WORDS)
    own.seen.limit = 100
    assert [x.tolist() for x in own.encode(texts)] == want


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (None, "", 6), (1, None, 5), (2, "hello world", 7)], "doc_id long, text string, ids int")
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids"]) for r in bpe.encode_documents(df, WORDS).collect())
    assert [g[:2] for g in got] == [(0, 0), (1, 0), (1, 0), (2, 2)]
    back = bpe.decode_documents(bpe.encode_documents(df, WORDS), WORDS).where("doc_id = 2").first()["text"]
    assert back == "hello</w> world</w>"
    assert bpe.encode_documents(df.limit(0), WORDS).count() == 0
    read = token_files.tokens_in_files(df, BYTES).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in read] == [(None, 0, 1), (1, 1, 1), (1, 2, 1), (2, 3, 3)]
    assert token_files.tokens_in_files(df.limit(0), BYTES).count() == 0


def test_queries_against_the_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    lib = Tokenizer.from_file(WORDS)
    got = {r["doc_id"]: tuple(r) for r in op3_bpe(spark, sf).collect()}
    for d in docs:
        ids = lib.encode(d["text"], add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        assert got[d["doc_id"]] == (d["doc_id"], len(ids), *want)
    lib, start = Tokenizer.from_file(BYTES), 0
    got = {r["doc_id"]: tuple(r) for r in op10_token_files(spark, sf).collect()}
    for d in docs:
        ids = [*lib.encode(d["text"], add_special_tokens=False).ids, 2]
        assert got[d["doc_id"]] == (d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_workers_forget_what_they_saw(spark, sf):
    """A worker that waits for its next task keeps the vocabulary, but no pairs of tokens and no pre-tokens."""
    import pyarrow as pa

    from sluice.llm import bpe
    from sluice.llm.catalog import vocabulary

    path = vocabulary("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(8)
    assert bpe.encode_documents(docs, path).where("n_tokens > 0").count() > 0

    def kept(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(bpe.encoder(path).words.pairs)] * batch.num_rows, pa.int64())], ["pairs"])

    assert {r["pairs"] for r in spark.range(0, 64, 1, 16).mapInArrow(kept, "pairs bigint").collect()} == {0}
