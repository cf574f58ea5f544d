"""Merkle manifest of a dataset: a hash tree over the rows of each group, and one over the groups.

Nodes are numbered in order within their group. The children of a parent are
spread into ``FANOUT`` columns by conditional aggregates (one column for each
slot): all columns one after another are what the parent hashes, all but a
child's own column are the siblings that its proof needs. Levels shrink by the
fanout, so everything above the leaves costs a seventh of the leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import lower_ascii, width
from sluice.session import written

FANOUT = 8
SLOTS = [f"slot_{k}" for k in range(FANOUT)]
# What a proof has at one level: the siblings on both sides, each side as one text.
SIDES = "array<struct<before string, after string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after another; a NULL part is left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return digest(*[field(f) for f in fields])


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Stored rows with ``at``, from 0 without gaps in order within their group, and ``n``, the group's number of rows.

    Rows are sorted in ranges of group and order; each (range, group) then adds
    the rows of the ranges before it. So a group takes as many tasks as its rows need.
    """
    keys = [group, *order]
    ranged = rows.repartitionByRange(width(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = written(ranged.withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("range", F.shiftright("place", 33))
    runs = placed.groupBy(group, "range").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    # One row for each range that a group lies in.
    before = f"coalesce(sum(rows) OVER (PARTITION BY {group} ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    starts = runs.select(
        group, "range", (F.expr(before) - F.col("first")).alias("shift"), F.expr(f"sum(rows) OVER (PARTITION BY {group})").alias("n")
    )
    joined = placed.join(starts.hint("merge"), [group, "range"])
    return joined.withColumn("at", F.col("place") + F.col("shift")).drop("place", "range", "shift")


def _parents(nodes: DataFrame, group: str, children: list[str]) -> DataFrame:
    """``group, at, n, hash`` and slots of the level above; groups of one node end here."""
    slot = F.pmod("at", F.lit(FANOUT))
    up = nodes.where("n > 1").withColumns({"slot": slot, "parent": F.floor(F.col("at") / FANOUT).cast("long")})
    spread = [F.max(F.when(F.col("slot") == k, F.struct(*children))).alias(name) for k, name in enumerate(SLOTS)]
    # All rows of a group carry the same n.
    pivot = up.groupBy(group, "parent").agg(F.ceil(F.max("n") / FANOUT).cast("long").alias("n"), *spread)
    return pivot.select(group, F.col("parent").alias("at"), "n", digest(*[F.col(s)["hash"] for s in SLOTS]).alias("hash"), *SLOTS)


def grown(leaves: DataFrame, group: str, carry: list[str]) -> list[DataFrame]:
    """The levels of a forest, one tree for each group, from its leaves (``group, at, n, hash`` and ``carry``) up."""
    levels, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = ["hash", *(carry if len(levels) == 1 else [])]
        levels.append(written(_parents(levels[-1], group, below), "merkle-level"))
        most = -(-most // FANOUT)
    return levels


def tops(levels: list[DataFrame], group: str) -> DataFrame:
    """``group, hash``: what remains of each group."""
    out = None
    for nodes in levels:
        top = nodes.where("n = 1").select(group, "hash")
        out = top if out is None else out.unionByName(top)
    return out


def _children(parents: DataFrame, group: str, keep: list[str], carry: list[str]) -> DataFrame:
    """Every child of parents with ``sides``, with its own: the siblings are all slot columns but its own."""
    hashes = [F.col(s)["hash"] for s in SLOTS]

    def child(k: int) -> Column:
        sides = F.struct(F.concat_ws("", *hashes[:k]).alias("before"), F.concat_ws("", *hashes[k + 1 :]).alias("after"))
        here = [F.lit(k).alias("slot"), sides.alias("here"), F.col(SLOTS[k])["hash"].alias("hash")]
        return F.when(F.col(SLOTS[k]).isNotNull(), F.struct(*here, *[F.col(SLOTS[k])[c].alias(c) for c in carry]))

    each = parents.select(group, "at", "sides", *keep, F.explode(F.array(*[child(k) for k in range(FANOUT)])).alias("c"))
    return each.where(F.col("c").isNotNull()).select(
        group, (F.col("at") * FANOUT + F.col("c.slot")).alias("at"), "c.hash",
        F.concat(F.array(F.col("c.here")), F.col("sides")).cast(SIDES).alias("sides"), *keep, *[F.col(f"c.{c}") for c in carry],
    )


def proven(levels: list[DataFrame], roots: DataFrame, group: str, keep: list[str], carry: list[str]) -> DataFrame:
    """Every leaf with ``sides``, the siblings at each level, lowest first, going on with those that its group has in ``roots``.

    ``roots`` has one row a group: ``group, sides`` and ``keep``. From the top
    down: a level's nodes are the children of the nodes above and the groups that end there.
    """
    above = None
    for height in range(len(levels) - 1, -1, -1):
        nodes = levels[height]
        ending = nodes.where("n = 1").join(roots.hint("merge"), group)
        if height == 0:
            lone = ending.select(group, "at", "hash", "sides", *keep, *carry)
            return lone if above is None else _children(above, group, keep, carry).unionByName(lone)
        found = ending.select(group, "at", *SLOTS, "sides", *keep)
        if above is not None:
            inner = _children(above, group, keep, []).drop("hash")
            found = found.unionByName(nodes.where("n > 1").join(inner.hint("merge"), [group, "at"]).select(*found.columns))
        above = found
    raise ValueError("a forest has at least its leaves")


def folded(leaf: Column, sides: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    return F.aggregate(sides, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    A leaf is the hash of a row's ``doc_id, source, lang, n_chars, text``; the
    trees of the languages are over rows in order of ``doc_id``, the tree above
    them over languages in order. ``tampered`` says of which rows the text is lower-cased (A-Z)
    before the proof is folded; all other proofs are folded from the leaf as it was.

    Any column may be NULL; a NULL ``doc_id`` comes first, a NULL ``lang`` is a
    language of its own, the first one. Rows that repeat an id are in order of
    their leaves, so equal rows may stand for each other. An empty text is not NULL.
    An empty table has no root and gives no rows. Further columns have no effect.
    """
    columns = {c: F.col(f"`{c}`") for c in FIELDS}
    changed = leaf_of([lower_ascii(columns[c]) if c == "text" else columns[c] for c in FIELDS])
    tampered = F.lit(False) if tampered is None else tampered
    hashed = docs.select(
        columns["doc_id"].cast("long").alias("doc_id"),
        # In the order of bytes, NULL is first.
        F.coalesce(F.concat(F.lit("="), columns["lang"]), F.lit("")).alias("branch"),
        leaf_of(list(columns.values())).alias("hash"),
        F.when(tampered, changed).alias("changed"),
        # Tells equal rows apart, so that ranges may cut between them.
        F.monotonically_increasing_id().alias("row"),
    )
    # Stored, so that each text is read and hashed once and not for the ranges too.
    rows = written(hashed, "merkle-leaves")
    leaves = written(numbered(rows, "branch", ["doc_id", "hash", "row"]).drop("row"), "merkle-numbered")
    carry = ["doc_id", "changed"]
    levels = grown(leaves, "branch", carry)

    branches = tops(levels, "branch").withColumn("tree", F.lit(0))
    upper = written(numbered(branches, "tree", ["branch"]), "merkle-branches")
    upper_levels = grown(upper, "tree", ["branch"])
    root = tops(upper_levels, "tree").select("tree", F.col("hash").alias("root"), F.array().cast(SIDES).alias("sides"))
    roots = proven(upper_levels, root, "tree", ["root"], ["branch"])
    roots = written(roots.select("branch", F.col("hash").alias("subroot"), "root", "sides"), "merkle-roots")

    proofs = proven(levels, roots, "branch", ["subroot", "root"], carry)
    proof = F.array_join(F.transform("sides", lambda s: F.concat(s["before"], s["after"])), "")
    out = proofs.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "hash"), F.col("sides")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
