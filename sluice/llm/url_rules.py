"""URL filters: fixed rules by host and path, and association rules mined from labelled URLs.

FP-growth finds the combinations of URL tokens that enough bad URLs share. How many other URLs have them
is counted exactly; those that pass the bounds on support and confidence, and that no
part of theirs makes needless, are rules: a table, matched through an index on one token of each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import lower_ascii, width
from sluice.session import written


@dataclass(frozen=True)
class Mining:
    """Bounds of mined rules, of whatever number and length.

    ``least`` is a number of bad URLs, however many have labels;
    ``confidence`` must hold three standard deviations below what was found.
    """

    least: int = 20
    confidence: float = 0.5


@dataclass(frozen=True)
class HostRule:
    """Fits a host and all its subdomains where the path starts with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_rule(line: str) -> HostRule:
    """From ``block example.org/es/``."""
    verdict, text = line.split()
    if verdict not in ("allow", "block") or "/" not in text:
        raise ValueError(f"not a rule: {line}")
    host, slash, path = text.partition("/")
    return HostRule(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Different tokens of a URL: labels of the host, segments of the path, query parts, fragment; digits become ``0``."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(?s)^[^#]*#(.*)$", 1)

    def named(kind: str, parts: Column) -> Column:
        full = F.filter(parts, lambda p: p != "")
        return F.transform(full, lambda p: F.concat(F.lit(kind), F.regexp_replace(p, "[0-9]+", "0")))

    parts = [
        named("host:", F.split(host_of(url), r"\.")), named("path:", F.split(path_of(url), "/")),
        named("query:", F.split(query, "&")), named("fragment:", F.array(fragment)),
    ]
    return F.coalesce(F.array_distinct(F.concat(*parts)), F.array().cast("array<string>"))


# Columns of mined rules. ``needs`` has a list of tokens for each part of a rule, of which a URL must have one; ``n``
# URLs have all parts, ``n_bad`` of them are bad.
RULES = "needs array<array<string>>, n long, n_bad long"
# Digits of the number of good URLs that starts an item's name.
_DIGITS = 18


def _sure(n_bad: Column, n: Column, confidence: float) -> Column:
    share = n_bad / n
    return share - 3 * F.sqrt(share * (1 - share) / n) >= confidence


# About as many URLs are held at once as bit rows, one bit a URL.
_PART, _BLOCK = 1 << 17, 1 << 16


def _parts(item: Column) -> Column:
    """Into how many parts the good URLs with an item are dealt."""
    return (1 + F.floor(F.substring(item, 1, _DIGITS).cast("long") / _PART)).cast("int")


def _contained(sets: pa.Table, urls: pa.Table) -> pa.Table:
    """How many of the URLs have all items of each set, the sets being of one size: bits of items are joined by AND."""
    counts = np.zeros(len(sets), dtype=np.int64)
    if len(sets) and len(urls):
        flat = pc.list_flatten(sets.column("items").combine_chunks())
        known = pc.unique(flat)
        wanted = pc.index_in(flat, known).to_numpy().reshape(len(sets), -1)
        for at in range(0, len(urls), _BLOCK):
            block = urls.slice(at, _BLOCK)
            lists = block.column("of").combine_chunks()
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            found = pc.index_in(pc.list_flatten(lists), known).to_numpy(zero_copy_only=False)
            url = np.repeat(np.arange(len(block)), sizes)
            here = ~np.isnan(found) if found.dtype.kind == "f" else found >= 0
            bits = np.zeros((len(known), -(-len(block) // 64) * 64), dtype=bool)
            bits[found[here].astype(np.int64), url[here]] = True
            words = np.packbits(bits, axis=1).view(np.uint64)
            step = max(1, (1 << 23) // max(words.shape[1], 1))
            for low in range(0, len(sets), step):
                some = wanted[low : low + step]
                both = words[some[:, 0]]
                for k in range(1, some.shape[1]):
                    both &= words[some[:, k]]
                counts[low : low + step] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return pa.table({"set": sets.column("set"), "n_good": pa.array(counts)})


def _good_urls(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """``sets`` (set, items, n_bad) with ``n_good``: how many good URLs have all items. URLs are tried with the sets whose rarest item they have."""
    keyed = sets.withColumn("key", F.array_min("items")).where(F.substring("key", 1, _DIGITS).cast("long") > 0)
    left = keyed.select("set", "items", "key", F.explode(F.sequence(F.lit(0), _parts(F.col("key")) - 1)).alias("part"))
    urls = rows.where("NOT bad").select("row", F.col("items").alias("of"), F.explode("items").alias("key"))
    right = urls.select("of", "key", F.pmod(F.xxhash64("row"), _parts(F.col("key"))).cast("int").alias("part"))
    groups = left.groupBy("key", "part").cogroup(right.groupBy("key", "part"))
    counted = groups.applyInArrow(_contained, "set long, n_good long").groupBy("set").agg(F.sum("n_good").alias("n_good"))
    return sets.join(counted.hint("merge"), "set", "left").withColumn("n_good", F.coalesce("n_good", F.lit(0)))


def mine_rules(labelled: DataFrame, mining: Mining | None = None) -> DataFrame:
    """All rules from rows (tokens ARRAY<STRING>, bad BOOLEAN) that pass the bounds and of which no part passes them.

    Tokens that pass alone are rules and need not be looked at further: what has one of them fits already.
    Of the others, those that are in the same URLs are one item, so that a template of many tokens costs no more
    than one. FP-growth over the bad URLs gives all sets of items that ``least`` of them have. Level by level
    the good URLs of those sets are counted, no part of which is a rule.

    Returns ``RULES``. Rows without tokens count for no rule; without rows there are no rules. Repeated
    rows count as often as they are there.
    """
    mining = mining or Mining()
    spark = labelled.sparkSession
    rows = labelled.where(F.size("tokens") > 0).select(F.monotonically_increasing_id().alias("row"), "bad", F.array_distinct("tokens").alias("tokens"))
    rows = written(rows, "url-rows")
    each = rows.select("row", "bad", F.explode("tokens").alias("token"))
    # Tokens with equal hashes of their rows are in the same rows.
    tokens = each.groupBy("token").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.bit_xor(F.xxhash64("row")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "row")).alias("h2"),
    )
    tokens = written(tokens.where(F.col("n_bad") >= mining.least), "url-tokens")
    alone = _sure(F.col("n_bad"), F.col("n"), mining.confidence)
    rules = tokens.where(alone).select(F.array(F.array("token")).alias("needs"), "n", "n_bad")
    same = tokens.where(~alone).groupBy("n", "n_bad", "h1", "h2").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    # An item's name starts with its number of good URLs, so that the least name of a set is its rarest item.
    item = F.concat(F.lpad((F.col("n") - F.col("n_bad")).cast("string"), _DIGITS, "0"), F.lit(" "), F.element_at("tokens", 1))
    items = written(same.select(item.alias("item"), F.element_at("tokens", 1).alias("token"), "tokens", "n"), "url-items")
    if items.isEmpty():
        return rules
    named = _unique_join(each, items.select("token", "item", "n"), "token", "n")
    baskets = written(named.groupBy("row", "bad").agg(F.sort_array(F.collect_list("item")).alias("items")), "url-baskets")
    # Half a URL less than the least number, so that rounding leaves no set out.
    bad = baskets.where("bad")
    growth = FPGrowth(itemsCol="items", minSupport=min(1.0, (mining.least - 0.5) / max(bad.count(), 1)), numPartitions=width(spark))
    found = growth.fit(bad).freqItemsets.where(F.size("items") > 1)
    sets = found.select(F.monotonically_increasing_id().alias("set"), F.sort_array("items").alias("items"), F.col("freq").alias("n_bad"))
    sets = written(sets, "url-sets")

    longest = sets.agg(F.max(F.size("items"))).first()[0] or 1
    settled, mined = None, None
    for size in range(2, longest + 1):
        level = sets.where(F.size("items") == size)
        if settled is not None:
            # A part of a set is a rule, or has one in it.
            parts = F.transform("items", lambda i: F.array_remove(F.col("items"), i))
            below = level.select("items", F.explode(parts).alias("part")).join(settled.hint("merge"), "part").select("items").distinct()
            closed = written(below, "url-closed")
            level = level.join(closed.hint("merge"), "items", "left_anti")
        counted = _good_urls(level, baskets).withColumn("n", F.col("n_bad") + F.col("n_good"))
        passed = written(counted.where(_sure(F.col("n_bad"), F.col("n"), mining.confidence)).select("items", "n", "n_bad"), "url-passed")
        mined = passed if mined is None else mined.unionByName(passed)
        done = passed.select(F.col("items").alias("part"))
        settled = done if size == 2 else done.unionByName(closed.select(F.col("items").alias("part")))
    if mined is None:
        return rules
    parts = mined.select("items", "n", "n_bad", F.explode("items").alias("item"))
    wide = parts.withColumnRenamed("n", "n_all").join(items.select("item", "tokens").hint("merge"), "item")
    whole = wide.groupBy("items", "n_all", "n_bad").agg(F.sort_array(F.collect_list("tokens")).alias("needs"))
    return rules.unionByName(whole.select("needs", F.col("n_all").alias("n"), "n_bad"))


# Of keys with more than 1 / HOT_SHARE of all rows there are at most HOT_SHARE, so that those may be broadcast.
HOT_SHARE = 10_000


def _unique_join(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Rows with a table of unique keys whose ``count`` is the key's number of rows; hot keys are broadcast, all others shuffled."""
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = table.where(F.col(count) > total / HOT_SHARE)
    rest = table.where(F.col(count) <= total / HOT_SHARE)
    few = rows.join(F.broadcast(hot), key)
    return few.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest.hint("merge"), key)).drop(count)


def rule_text(needs: Column) -> Column:
    """A rule's tokens; those that stand for each other are joined by ``|``."""
    return F.array_join(F.transform(needs, lambda some: F.array_join(some, "|")), " ")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``row, mined_rule``: the surest rule that fits, for each of ``urls`` (row, tokens) that one fits.

    Rules are looked up by the tokens of one of their parts. URLs with one token are dealt to many tasks, each of
    which has the rules of that token.
    """
    tasks = width(urls.sparkSession)
    best = F.named_struct(
        F.lit("confidence"), F.col("n_bad") / F.col("n"), F.lit("support"), F.col("n_bad"), F.lit("text"), rule_text(F.col("needs"))
    )
    index = rules.select("needs", best.alias("best"), F.explode(F.element_at("needs", 1)).alias("token"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    each = urls.select("row", "tokens", F.explode("tokens").alias("token")).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(tasks)).cast("int"))
    fits = F.forall("needs", lambda some: F.arrays_overlap(some, F.col("tokens")))
    found = each.join(index.hint("merge"), ["token", "part"]).where(fits)
    return found.groupBy("row").agg(F.max("best").alias("best")).select("row", F.col("best.text").alias("mined_rule"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, bad) of pages that have a label: bad is low quality or toxic. Labels without a value are left out."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.where(bad.isNotNull()).select(F.col("doc_id").alias("label_id"), bad.alias("bad"))
    urls = pages.select("page_id", "url")
    return urls.join(known, F.col("page_id") == F.col("label_id")).select(url_tokens(F.col("url")).alias("tokens"), "bad")


def judge_urls(pages: DataFrame, rules: list[HostRule], mined: DataFrame | None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule`` of every row.

    The longest host rule that fits decides; where none does, a mined rule that
    fits blocks, and all else is allowed. A NULL URL has no host, path or
    tokens. Ids may be NULL or repeat; rows are independent of each other. ``mined`` has the columns of
    ``RULES``; without it, or without rows in it, only host rules block. An empty table gives no rows.
    """
    slim = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    parts = slim.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), url_tokens(F.col("url")).alias("tokens"))
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    ruled = parts.select("page_id", "host", "path", "tokens", rule.alias("rule"), verdict.alias("fixed"))
    if mined is None:
        done = ruled.withColumn("mined_rule", F.lit(None).cast("string"))
    else:
        stored = written(ruled.withColumn("row", F.monotonically_increasing_id()), "url-parts")
        found = matched(stored.where("fixed IS NULL").select("row", "tokens"), mined)
        done = stored.join(found.hint("merge"), "row", "left")
    blocked = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return done.select("page_id", "host", "path", "rule", F.coalesce("fixed", blocked).alias("verdict"), "mined_rule")
