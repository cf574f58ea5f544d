import hashlib
import random

import numpy as np

from sluice.llm import fingerprints as P
from sluice.llm.catalog import op8_fingerprints

RND = random.Random(1)
TABLE = P.information(np.random.default_rng(2).integers(0, 900, (256, 256)))
WORDS = ["".join(RND.choice("abcdefghiklmnopé") for _ in range(RND.randint(2, 9))) for _ in range(3000)]


def text_of(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def brute_picked(data):
    """The popular windows by definition."""
    windows = len(data) - P.WINDOW + 1
    if windows < 1:
        return [0]
    value = [sum(TABLE[data[i + k] * 256 + data[i + k + 1]] for k in range(P.WINDOW - 1)) for i in range(windows)]
    span, counts = min(P.NEIGHBOURS, windows), {}
    for a in range(windows - span + 1):
        best = max(range(a, a + span), key=lambda i: (value[i], -i))
        counts[best] = counts.get(best, 0) + 1
    enough = sorted(p for p, c in counts.items() if c >= min(P.POPULAR, windows - span + 1))
    return enough or [min(counts)]


def test_windows_against_brute_force(monkeypatch):
    for seed, n in ((1, 3), (2, 8), (3, 15), (4, 120), (5, 200)):
        data = text_of(seed, n).encode()
        want = brute_picked(data)
        for part in (1 << 22, 50, 7):
            monkeypatch.setattr(P, "PART", part)
            assert P.picked(np.frombuffer(data, dtype=np.uint8), TABLE).tolist() == want
    assert P.picked(np.frombuffer(b"ab" * 400, dtype=np.uint8), TABLE).tolist()


def test_likeness():
    a, b = text_of(10, 800), text_of(11, 900)
    one, two = P.Digest.of(a, TABLE), P.Digest.of(b, TABLE)
    assert one.likeness(one) == 1.0 and one.likeness(two) == two.likeness(one) < 0.05
    half = P.Digest.of(P.edited(a, b), TABLE)
    assert 0.3 < one.likeness(half) < 0.8 and 0.2 < two.likeness(half)
    moved = P.Digest.of("a few words in front " + a, TABLE)
    assert one.likeness(moved) > 0.9
    empty = P.Digest.of("", TABLE)
    assert empty.likeness(empty) == 1.0 and empty.likeness(one) == one.likeness(empty) == 0.0
    for d in (one, two, empty, P.Digest.of("x", TABLE)):
        back = P.Digest.parse(d.text())
        assert back.text() == d.text() and back.likeness(d) == 1.0


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else P.LOWEST), r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((d, len(t), t[: len(t) - half] + following[:half]))
    return sorted(map(repr, out))


def test_order_edges(spark):
    rows = [(i * 13 % 101, text_of(i, i % 30)) for i in range(101)] + [(None, "z"), (None, None), (50, "again"), (50, ""), (-7, "é" * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS tail", "3 AS key")
    got = P.compare_with_next(df).select("doc_id", "n_chars", "edited_text").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)
    assert P.compare_with_next(df.limit(0)).count() == 0
    single = P.compare_with_next(spark.createDataFrame([(1, "one text")], "doc_id long, text string")).collect()
    assert [(r["edited_text"], r["near_next"]) for r in single] == [("one one ", 1.0)]


def test_query(spark, sf):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op8_fingerprints(spark, sf).collect()
    want = {eval(r)[0]: hashlib.sha256(eval(r)[2].encode()).hexdigest() for r in brute(list(rows.items()))}
    assert {r["doc_id"]: r["edited_sha256"] for r in got} == want
    prints = {}
    for r in got:
        prints.setdefault(rows[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    long = [r for r in got if r["n_chars"] >= 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.98
