from sluice.llm.quality import judge_quality, keep_quality


def brute(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


EDGES = [
    None, "", " \t\n", "a", "the " * 8, "the " * 7, "x y z " * 20, "a b c d e f g h " * 2, "line one of it\nline one of it\n\n\n",
    "é b ß\x0b# $ <|>\r\n", "of the and to in " * 6 + "clean words here as it is", "w1 w2 w3 w4 w5 w6 w7 w8 x w1 w2 w3 w4 w5 w6 w7 w8",
    "aa " * 30000,
]


def test_base_counts_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(EDGES)], "doc_id long, text string, kept long")
    got = {r["doc_id"]: r for r in judge_quality(df).collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for i, t in enumerate(EDGES[:-1]):
        assert tuple(got[i][n] for n in names) == brute(t), t
    assert got[len(EDGES) - 1]["n_repeat_words"] == 30000
    assert all(not r["kept"] for r in got.values() if r["base_failed"])


def test_empty_tables_repeats_and_null_ids(spark):
    schema = "doc_id long, text string, row string, words int"
    assert judge_quality(spark.createDataFrame([], schema)).count() == 0
    clean = " ".join(f"the of word{i} and" for i in range(20))
    df = spark.createDataFrame([(None, clean, "r", 1), (None, clean, "r", 1), (3, "***", "q", 2)], schema)
    assert [tuple(r) for r in keep_quality(df).collect()] == [(None, clean, "r", 1)] * 2


def test_no_python_and_no_exchange(spark, sf):
    plan = judge_quality(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan


def test_languages_without_stop_words(spark):
    """The stop-word rule holds for languages that have a list only."""
    polish = " ".join(f"słowo{i} jest tutaj oraz" for i in range(10))
    rows = [(1, polish, "pl"), (2, polish, "en"), (3, polish, None), (4, polish, "de-AT"), (5, polish + " the of und la", "fr"), (6, "x y z " * 20, "pl")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in keep_quality(df).collect()} == {1, 3, 5}
    assert keep_quality(df.drop("lang")).count() == 1
