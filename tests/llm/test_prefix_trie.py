import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.llm.catalog import SQL, op11_prefix_trie
from sluice.llm.prefix_trie import ZFastTrie, conversation_trie, prefix_hashes, two_fattest
from tests.llm.helpers import duck_rows, rows

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def brute(turns):
    own = {}
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((t is not None, t or 0, tie), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, mine in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c - int(c / 5) * 5)
        paths[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    kids = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[b] for b in below) or 1
        size = len(k[-1][1].encode()) if k else 0
        saved[k] = sum(saved[b] for b in below) + (len(members[k]) - 1) * size
    out = []
    for k, m in members.items():
        ends = sorted(c for c in m if len(paths[c]) == len(k))
        up = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), up, len(m), len(kids.get(k, [])), leaves[k], saved[k], sha(ends)))
    return sorted(map(repr, out))


def found(df, **options):
    return sorted(repr(tuple(r)) for r in conversation_trie(df, **options).select(*NAMES).collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def sample(n, seed=1):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        # A third are one and the same conversation, a third share their first turn.
        words = ["hello", "yes"] if c % 3 == 0 else ["hello" if c % 3 == 1 else rng.choice("abc"), *[rng.choice("xy") for _ in range(rng.randint(0, 12))]]
        out += [(c, i, "user" if i % 2 == 0 else "bot", w) for i, w in enumerate(words)]
    return out


ODD = [
    (None, 0, "user", "nobody's"), (1000, None, None, None), (1000, None, "user", None), (1000, 3, "", "ü" * 50_000), (1000, 3, "a", "tie"),
    (1000, 3, "a", "tie"), (-3, 0, "user", "hello"), (-5, 0, "user", "hello"), (2001, 1, "x", "only"),
]


@pytest.mark.parametrize("trie_turns", [1, 60, 1 << 17])
def test_against_brute_force(spark, trie_turns):
    turns = sample(160) + ODD + [(5000, i, "user", f"turn {i % 7}") for i in range(900)]
    random.Random(2).shuffle(turns)
    df = spark.createDataFrame(turns, SCHEMA).withColumns({"own": F.lit(1), "base": F.lit("b"), "hash": F.lit(0), "a b.c": F.lit(1)})
    assert found(df, trie_turns=trie_turns) == brute(turns)


def test_empty_table_and_turnless_conversation(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty) == []
    # The first h turns are taken from a conversation that is not there.
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:3]
    turns = [(c, 0, "user", "gone") for c in short]
    got = found(spark.createDataFrame(turns, SCHEMA))
    assert got == brute(turns) and len(got) == 1


def test_exit_nodes_are_those_of_a_scan():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    trie, seen = ZFastTrie(), set()
    for at in range(0, 400, 50):
        batch = texts[at : at + 50]
        trie.insert([(i, prefix_hashes([bytes([b]) for b in t]), [1] * len(t)) for i, t in enumerate(batch, at)])
        seen |= set(batch)
        for t in texts:
            path = prefix_hashes([bytes([b]) for b in t])
            common = max(len(p) for p in (t[:d] for d in range(len(t) + 1)) if any(s.startswith(p) for s in seen))
            node = trie.exit_node(path)
            assert trie.top[node] < common <= trie.depth[node] or (common == 0 and node == 0) or common == trie.depth[node]
            assert trie.path[node][common] == path[common]
    assert sum(len(e) for e in trie.ends) == 400
    assert len(trie.handles) == len(trie.top) - 1


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            best = max(range(low + 1, high + 1), key=lambda n: n & -n)
            assert two_fattest(low, high) == best


def test_query(spark, sf):
    assert rows(op11_prefix_trie(spark, sf)) == duck_rows(sf, SQL["op11_prefix_trie"])
