import random
import zlib

import pytest

from sluice.llm import sharding
from sluice.llm.catalog import op1_sharding
from sluice.llm.sharding import minimax_cuts, own_shards, shard_documents


def greedy(sizes, capacity):
    cuts, now, at = [], 0, 0
    for s in sizes:
        if s > capacity:
            return None
        if now + s > capacity:
            cuts.append(at)
            now = 0
        now, at = now + s, at + s
    return [*cuts, at]


def brute(sizes, shards):
    for capacity in range(max(max(sizes), -(-sum(sizes) // shards)), sum(sizes) + 1):
        cuts = greedy(sizes, capacity)
        if cuts and len(cuts) <= shards:
            return cuts + [cuts[-1]] * (shards - len(cuts))


@pytest.mark.parametrize("look", [4, 9, 20_000])
def test_cuts_against_brute_force(spark, monkeypatch, look):
    monkeypatch.setattr(sharding, "LOOK", look)
    rnd = random.Random(look)
    for shards, count in ((1, 5), (3, 2), (4, 40), (7, 60)):
        sizes = [rnd.choice([1, 3, 17, rnd.randint(1, 90)]) for _ in range(count)]
        ends = [sum(sizes[: i + 1]) for i in range(count)]
        groups = spark.createDataFrame([(e,) for e in ends], "end long")
        assert minimax_cuts(groups, ends[-1], max(sizes), shards) == brute(sizes, shards)
    assert minimax_cuts(groups.limit(0), 0, 0, 3) == [0, 0, 0]


def test_groups_of_more_than_a_share():
    assert own_shards([50, 20, 10, 10], 100, 4) == 2
    assert own_shards([], 0, 4) == 0
    assert own_shards([100], 100, 1) == 0
    assert own_shards([10, 10, 10, 10], 40, 4) == 3


def check(rows, got, shards):
    texts = sorted((d, t or "") for d, t in rows if d is not None)
    assert len(got) == len(rows) and all(0 <= r["shard"] < shards for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    found = sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None)
    assert found == sorted((d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in texts)
    shard_of = {}
    for r in got:
        shard_of.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in shard_of.values())


def test_edges(spark):
    rows = [(i, "copy " * 40) for i in range(300)] + [(i + 500, f"é{i} " * (i % 40)) for i in range(400)]
    rows += [(None, None), (None, ""), (500, None), (3, "copy " * 40), (9999, "long " * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "'x' AS h1", "2 AS size")
    for shards in (1, 7, 40):
        check(rows, shard_documents(df, shards).collect(), shards)
    assert shard_documents(df.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        shard_documents(df, 0)


def test_query_is_near_equal(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op1_sharding(spark, sf).collect()
    check(rows, got, 40)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    sums = [sum(r["size"] for r in got if r["shard"] == k) for k in range(40)]
    largest = max(len(t.encode()) + 16 for _, t in rows)
    assert max(sums) <= sum(sums) / 40 + largest
