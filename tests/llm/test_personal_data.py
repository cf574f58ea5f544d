import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sluice.llm import personal_data as P
from sluice.llm.catalog import op12_personal_data
from sluice.llm.common import table

RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", lambda v: luhn(re.sub("[^0-9]", "", v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
}
TERM = re.compile("[A-Za-z0-9\x80-\U0010ffff]+")


def luhn(d):
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(d))]
    return 13 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def base(text):
    return [(k, *m.span()) for k, (p, holds) in RULES.items() for m in re.finditer(p, text) if holds(m.group())]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def entity(kind, value):
    if kind == "email":
        return kind, value.lower()
    return kind, ".".join(str(int(p)) for p in value.split(".")) if kind == "ip" else re.sub("[^0-9]", "", value)


def brute(docs, rule=P.Disclosure()):
    """(doc_id, spans) with every count kept by term and entity themselves."""
    texts = [t or "" for _, t in docs]
    in_rows, near = {}, {}
    for row, t in enumerate(texts):
        for m in TERM.finditer(t):
            w = lower(m.group())
            in_rows.setdefault(w, set()).add(row)
            if len(w) > rule.letters:
                in_rows.setdefault((w[: rule.letters],), set()).add(row)
        spans = base(t)
        for k, s, e in spans:
            seen = near.setdefault(entity(k, t[s:e]), {})
            free = [
                m for m in TERM.finditer(t)
                if m.start() >= s - rule.chars and m.end() <= e + rule.chars and not any(a < m.end() and m.start() < b for _, a, b in spans)
            ]
            # The window's ends must not touch a term that goes on beyond them.
            for m in [m for m in free if m.end() <= s][-rule.terms :] + [m for m in free if m.start() >= e][: rule.terms]:
                w = lower(m.group())
                seen.setdefault(w, set()).add(row)
                if len(w) > rule.letters:
                    seen.setdefault((w[: rule.letters],), set()).add(row)
            seen.setdefault(None, set()).add(row)

    def reveals(terms, t):
        n_entity, n = len(terms[None]), len(texts)
        content = math.log(n / n_entity)
        return content > 0 and round(math.log(len(terms[t]) * n / (n_entity * len(in_rows[t]))) - rule.share * content, 9) >= 0

    general = {}
    for terms in near.values():
        for t in terms:
            if isinstance(t, str) and len({texts[r] for r in terms[t]}) >= rule.texts and reveals(terms, t):
                c = (t[: rule.letters],)
                general.setdefault(t, []).append(len(t) > rule.letters and not reveals(terms, c))
    out = []
    for (doc_id, _), t in zip(docs, texts):
        spans = base(t)
        terms = [
            (m.start(), m.end(), all(general[lower(m.group())])) for m in TERM.finditer(t)
            if lower(m.group()) in general and not any(a < m.end() and m.start() < b for _, a, b in spans)
        ]
        out.append((doc_id, spans, terms))
    return sorted(map(repr, out))


def found(df, **options):
    rows = P.personal_spans(df, **options).collect()
    return sorted(repr((r["doc_id"], [(P.KINDS[s[0]], s[1], s[2]) for s in r["base"]], [tuple(t) for t in r["terms"]])) for r in rows)


def sample(n=400):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(60)] + ["the", "of", "and", "é", "über", "reach", "me", "at", "or", "ask", "ip"]
    docs = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(3, 40)))
        if i % 40 == 0:
            text += f" Zaphodson{'' if i % 80 else ','} reach me at Zaphod.B@mail.example.com or zaphodson 4711qx; word{i}"
        if i % 50 == 1:
            text = f"ask Quillbert, +1 (499) 555-650{i % 7} " + text + " ip 010.1.2.255 Xyzzyplugh"
        docs.append((i, text))
    # The same words' first letters elsewhere, so that they reveal nothing; copies; words that lack evidence.
    docs += [(n + i, f"zapper zaplet and word{i}") for i in range(30)]
    docs += [(2000 + i, "copy: a@b.example.org uniquecopyword") for i in range(40)]
    return docs


ODD = [
    (None, None), (None, ""), (7, None), (3000, "x" * 3000), (3001, "1" * 2000 + "." + "1.1" * 500), (3002, "a@" * 300 + "b@c.d@e.f"),
    (3003, "éabc@x.example Zaphod.b@mail.example.com4 +" + "1" * 500 + " 4111-1111 1111 1111 999.1.1.1 000255.000.1.1.1.1.1"),
    (0, "word1 Zaphodson"), (0, "word1 Zaphodson"), (3004, "Zaphodson@mail.example.com zaphodson"),
]


def test_spans_against_brute_force(spark):
    docs = sample() + ODD
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"spans": F.lit(1), "term": F.lit("t"), "a b.c": F.lit(1)})
    got = found(df)
    assert got == brute(docs)
    assert sum("True" in g or "False" in g for g in got) >= 10


@pytest.mark.parametrize("text", ["ab.c@d-e.f.g, @x.y a@b a@b.c@d.e", "+12 345 678 9 (0) 1", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111 4111111111111111", "٣@x.y +1٣"])
def test_base_spans(text):
    assert [(P.KINDS[k], s, e) for k, s, e in P.base_spans(text)] == base(text)


def test_long_texts_take_linear_time():
    for text in ("x" * 3_000_000, "1" * 3_000_000, "1." * 1_000_000, "+1 " * 1_000_000, "a@" * 1_000_000, "1-" * 1_000_000 + "x"):
        start = time.monotonic()
        P.base_spans(text)
        assert time.monotonic() - start < 20


def test_long_texts_are_cut_outside_terms(monkeypatch):
    monkeypatch.setattr(P, "PART", 7)
    data = P._bytes_of("abc défghi, jklmnopqrst é " * 9)
    whole = P.terms_of(data, 3)
    parts = [P.terms_of(p, 3) for _, p in P._parts(data)]
    assert sum((p.hashes.tolist() for p in parts), []) == whole.hashes.tolist()


def test_sanitised_texts(spark):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("a b.c", F.col("doc_id"))
    out = {r["doc_id"]: r for r in P.sanitised(df).collect()}
    assert len(out) == len(docs) and all(r["a b.c"] == i for i, r in out.items())
    assert "reach me at <email> or zap*" in out[40]["text"] and "Zap*" in out[40]["text"] and "4711qx" not in out[40]["text"]
    assert out[2]["text"] == dict(docs)[2]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert found(df) == [] and P.sanitised(df).count() == 0


def test_query(spark, sf):
    docs = [(r[0], r[1]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in op12_personal_data(spark, sf).collect()}
    expected = {i: (b, t) for i, b, t in map(eval, brute(docs))}
    assert got.keys() == expected.keys()
    for i, (b, t) in expected.items():
        assert got[i]["spans"] == ",".join([f"{k}:{s}:{e}" for k, s, e in b] + [f"term:{s}:{e}" for s, e, _ in t])
        assert [got[i][f"n_{k}"] for k in P.KINDS] == [sum(x[0] == k for x in b) for k in P.KINDS]
