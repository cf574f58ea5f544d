import random
import re

import numpy as np
import pytest

from sluice.llm import components, ngram_join
from sluice.llm.catalog import op6_ngram_join
from sluice.llm.common import spread_join
from sluice.llm.components import connected
from sluice.llm.ngram_join import Alike, _packed, _unpacked, alike_groups, join_ngrams
from sluice.llm.shingles import shingle_set


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute_set(text, size=4):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=85):
    sets = [brute_set(t) for _, t in rows]
    lists, parent = {}, list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for k in s:
            lists.setdefault(k, []).append(i)
    for i, s in enumerate(sets):
        shared = {}
        for k in s:
            for j in lists[k]:
                shared[j] = shared.get(j, 0) + 1
        for j, o in shared.items():
            if j < i and 100 * o >= percent * (len(s) + len(sets[j]) - o):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return sorted((repr((d, len(sets[i]), low[find(i)])) for i, (d, _) in enumerate(rows)))


def near_copies(seed, count, groups, length):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rnd.choice(vocabulary) for _ in range(length)] for _ in range(groups)]
    rows = []
    for i in range(count):
        text = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 8)):
            text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        if rnd.random() < 0.2:
            text = text[: rnd.randint(1, len(text))]
        rows.append((i * 7 % count, " ".join(text)))
    return rows


def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(repr(tuple(r)) for r in op6_ngram_join(spark, sf).collect())
    assert got == brute(rows)


EDGES = [
    (9, None), (8, ""), (7, " \n\t"), (6, "one"), (5, "ONE"), (4, "one two three"), (3, "one\x0btwo three"), (2, "a b c d"), (1, "a b c d e"),
    (None, "one"), (6, "one"), (6, "other words of a text that repeats an id"), (30, "é É ü x y"), (31, "é é ü x y"), (32, "É" * 5 + " b c d"),
]


@pytest.mark.parametrize("small", [False, True])
def test_edges_and_near_copies(spark, monkeypatch, small):
    if small:  # frequent shingles, many flushes, groups in blocks
        for name, value in {"FREQUENT_LEAST": 2, "FLUSH": 500, "GROUP": 1500}.items():
            monkeypatch.setattr(ngram_join, name, value)
    rows = EDGES + [(i + 100, t) for i, t in near_copies(5, 150, 4, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS label", "3 AS s1")
    assert sorted(repr(tuple(r)) for r in join_ngrams(df).collect()) == brute(rows)


def test_rows_without_an_id(spark):
    rows = [(None if i % 3 else 7, t) for i, t in near_copies(9, 90, 4, 40)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(repr(tuple(r)) for r in join_ngrams(df).collect()) == brute(rows)


def test_components_of_a_star_and_a_path(spark):
    links = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000), (1, 0), (400, 399)]
    got = {r["node"]: r["label"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(401)} | {i: 1000 for i in range(1000, 1061)} | {5000: 5000}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, how):
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 50), (None, 51), (None, 52), (3, None)], "k int, v int")
    few = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, w string")
    want = many.join(few, "k", how).collect()
    assert sorted(map(repr, spread_join(many, few, ["k"], "v", how).select("k", "v", "w").collect())) == sorted(map(repr, want))


def test_empty_table(spark):
    assert join_ngrams(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_groups_in_a_task_are_exact(seed):
    texts = {t for _, t in near_copies(seed, 120, 3, 50)}
    by_set = {frozenset(shingle_set(t, 4).tolist()): t for t in texts}
    rows = list(enumerate(by_set.values()))
    found = alike_groups([shingle_set(t, 4) for _, t in rows], Alike())
    assert sorted(repr((i, len(brute_set(t)), found[i])) for i, t in rows) == brute(rows)


def test_packed_counts():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**40, 5000).astype(np.uint64))
    counts = np.arange(1, len(keys) + 1)
    a, b = _unpacked(_packed(keys, counts))
    assert (a == keys).all() and (b == counts).all()


def test_rounds_are_few_and_small(spark, sf, monkeypatch):
    """Broadcasts and exchanges cost the driver memory: rounds have no broadcasts and five exchanges; groups that fit in a task need no rounds."""
    plans, calls = [], []
    write, connect = components.written, ngram_join.connected

    def planned(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(components, "written", planned)
    monkeypatch.setattr(ngram_join, "connected", lambda links: calls.append(1) or connect(links))
    join_ngrams(spark.read.parquet(f"{sf}/documents.parquet"))
    assert len(calls) == 1
    assert not any("Broadcast" in p for p in plans) and max(len(re.findall(r"\bExchange", p)) for p in plans) <= 5
