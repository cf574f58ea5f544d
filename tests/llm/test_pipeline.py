import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from sluice.llm import mixing
from sluice.llm.catalog import SQL
from sluice.session import written
from tests.llm import test_line_dedup, test_ngram_join
from tests.llm.helpers import duck_rows


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {}
    for name, stage in C.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == C.COLUMNS
        after[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sql = "SELECT doc_id FROM (" + SQL["op9_quality"] + ") WHERE kept"
    kept = {int(re.findall(r"\d+", r)[0]) for r in duck_rows(sf, sql)}
    assert {i: texts[i] for i in kept} == dict(after["quality"]) and len(kept) == len(after["quality"])
    lines = {eval(r)[0]: eval(r)[3] for r in test_line_dedup.brute(after["quality"])}
    assert lines == dict(after["line_dedup"])
    groups = brute_groups(after["line_dedup"])
    assert dict(after["ngram_join"]) == {i: t for i, t in after["line_dedup"] if groups[i] == i}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    before = spark.createDataFrame(after["ngram_join"], "doc_id long, text string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.rate_documents(before, labels).collect()}
    want = sorted((i, t) for i, t in after["ngram_join"] for _ in range(copies[i]))
    assert sorted(after["mixing"]) == want and 0 < len(want)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = C.run(spark, sf)
    assert last.columns == ["doc_id", "n_tokens", "ids"]
    ids = [lib.encode(t, add_special_tokens=False).ids for _, t in want]
    assert sorted((r["doc_id"], r["n_tokens"], r["ids"]) for r in last.collect()) == [(i, len(x), x) for (i, _), x in zip(want, ids, strict=True)]


def brute_groups(rows, size=5, percent=80):
    sets = {i: test_ngram_join.brute_set(t, size) for i, t in rows}
    lists, parent = {}, {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for k in s:
            lists.setdefault(k, []).append(i)
    for i, s in sets.items():
        for j in {j for k in s for j in lists[k] if j < i}:
            overlap = len(s & sets[j])
            if 100 * overlap >= percent * (len(s) + len(sets[j]) - overlap):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in sets}


def test_edges(spark, sf, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, drops int"
    clean = " ".join(f"the word{i} of and" for i in range(30))
    rows = [(1, clean, None, "s", 5, "r", 1), (2, clean, "en", None, None, "r", 1), (1, clean, None, "s", 5, "r", 1), (3, None, "en", "s", 0, "r", 2), (None, clean + " x", "en", "s", 1, "r", 3)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for name, stage in C.STAGES:
            docs = written(stage(spark, docs, sf), name)
        found = [(r["doc_id"], r["n_tokens"] > 0) for r in docs.collect()]
        assert set(found) == ({(1, True)} if part else set())
