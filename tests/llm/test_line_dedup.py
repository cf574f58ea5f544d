import pytest

from sluice.llm.catalog import SQL, op5_line_dedup
from sluice.llm.line_dedup import dedup_lines
from tests.llm.helpers import duck_rows, rows


def brute(docs, min_chars=40, min_docs=5):
    def key(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        return low.strip(" \t\n\x0b\x0c\r")

    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(-1 if i is None else i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        at = -1 if i is None else i
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == at]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(repr, out))


LONG = ["x" * 40, "  A Line Of forty code points and some More\t", "é" * 39 + "É", "y" * 39, "a line of forty code points and some more"]
DOCS = [(i, "\n".join([LONG[i % 5], LONG[(i + 1) % 5], f"own {i}", "", LONG[0], LONG[0]])) for i in range(23)]
DOCS += [(None, LONG[0]), (None, LONG[0] + "\n"), (50, None), (51, ""), (22, LONG[2]), (22, LONG[2]), (52, "\n".join(LONG * 3000))]


@pytest.mark.parametrize(("batches", "fanout", "min_docs"), [(1, 2, 5), (4, 2, 5), (6, 3, 4), (5, 9, 1)])
def test_against_brute_force(spark, batches, fanout, min_docs):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS lines", "'k' AS kept", "2 AS h1")
    got = dedup_lines(df, batches=batches, fanout=fanout, min_docs=min_docs).select("doc_id", "n_lines", "n_dropped", "kept_text")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(DOCS, min_docs=min_docs)


def test_hot_lines_and_empty_table(spark, monkeypatch):
    import sluice.llm.line_dedup as module

    monkeypatch.setattr(module, "HOT_SHARE", 5)
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    got = dedup_lines(df).select("doc_id", "n_lines", "n_dropped", "kept_text")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(DOCS)
    assert dedup_lines(df.limit(0)).count() == 0


def test_query(spark, sf):
    assert rows(op5_line_dedup(spark, sf)) == duck_rows(sf, SQL["op5_line_dedup"])
