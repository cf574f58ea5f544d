import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.llm.catalog import SQL, op13_manifest
from sluice.llm.merkle import manifest
from tests.llm.helpers import duck_rows, rows

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """(root, proofs): siblings of each node on both sides, level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(proofs):
            run = at[i] // 8 * 8
            p.append((nodes[run : at[i]], nodes[at[i] + 1 : run + 8]))
        nodes, at = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)], [a // 8 for a in at]
    return (nodes[0] if nodes else None), proofs


def brute(docs):
    langs = sorted({d[2] for d in docs}, key=lambda x: b"" if x is None else b"=" + x.encode())
    trees = {}
    for lang in langs:
        mine = sorted((d for d in docs if d[2] == lang), key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees[lang] = (mine, *climb([leaf(d) for d in mine]))
    root, upper = climb([trees[lang][1] for lang in langs])
    out = []
    for lang, above in zip(langs, upper):
        mine, subroot, proofs = trees[lang]
        for d, proof in zip(mine, proofs):
            sides = proof + above
            low = None if d[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in d[4])
            tampered = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0
            fold = leaf((*d[:4], low)) if tampered else leaf(d)
            for before, after in sides:
                fold = h(*before, fold, *after)
            flat = [x for before, after in sides for x in before + after]
            out.append((d[0], leaf(d), subroot, root, h(*flat), fold, fold == root))
    return sorted(map(repr, out))


def found(spark, docs, **columns):
    df = spark.createDataFrame(docs, SCHEMA).withColumns(columns)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(repr(tuple(r)) for r in manifest(df, tampered).select(*names).collect())


ODD = [(None, None, None, None, None), (None, "s", None, 3, "Ab"), (-7, "s", "", 0, ""), (3, "s", "x", 1, "Æ\nZ" * 5000), (3, "s", "x", 1, "B"), (3, "s", "x", 1, "B")]


@pytest.mark.parametrize("n", [0, 9, 65, 600])
def test_against_brute_force(spark, n):
    docs = [(i * 3 - 5, "web", "hot" if i % 3 else f"l{i % 29}é", i, f"Text {i} Of Some Length") for i in range(n)]
    assert found(spark, docs) == brute(docs)


def test_odd_rows(spark):
    docs = ODD + [(i, "a", "en", i, "T" * i) for i in range(20)]
    # Extra columns, one of them with a name used inside.
    extra = {"branch": F.lit(1), "hash": F.lit("x"), "a b.c": F.lit(2)}
    assert found(spark, docs, **extra) == brute(docs)


def test_one_language_and_equal_rows(spark):
    docs = [(1, "s", "en", 1, "Same")] * 70 + [(2, "s", "en", 1, "X")]
    assert found(spark, docs) == brute(docs)


def test_query(spark, sf):
    got = rows(op13_manifest(spark, sf))
    assert got == duck_rows(sf, SQL["op13_manifest"])
    assert any("False" in r for r in got) and any("True" in r for r in got)
