"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    bpe,
    fingerprints,
    line_dedup,
    merkle,
    mixing,
    ngram_join,
    personal_data,
    prefix_trie,
    quality,
    sharding,
    token_files,
    url_rules,
    warc,
)
from sluice.llm.common import table

def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on this machine; it is the same on every machine."""
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    placed = placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives."""
    records = warc.archived_pages(table(spark, sf_dir, "pages"))
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their decoding, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"), digests=True)


# Fixed values of the query's contract.
HOST_RULES = [
    url_rules.host_rule(line)
    for line in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
]


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL by host rules, else by rules mined from the labels."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mined = url_rules.mine_rules(url_rules.labelled_urls(pages, table(spark, sf_dir, "labels")))
    return url_rules.judge_urls(pages, HOST_RULES, mined)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the long lines that five or more documents share."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngram_join.join_ngrams(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's domain posteriors and its rate towards the target weights."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rated = mixing.rate_documents(docs, labels)
    shares = [F.round(F.element_at("p", k + 1), 6).alias(f"p_{d}") for k, d in enumerate(mixing.DOMAINS)]
    return rated.select("doc_id", "n_tokens", *shares, F.round("rate", 6).alias("rate"), "copies")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against those of its edited text and of the next document."""
    compared = fingerprints.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the threshold table for every document."""
    judged = quality.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as ORC files and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.token_digests(token_files.tokens_in_files(docs, vocabulary("byte_bpe_50k.json")))


def _listed(*texts: Column) -> Column:
    """Those of the texts that are not empty, comma-joined."""
    return F.concat_ws(",", *[F.when(t != "", t) for t in texts])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations")).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    )


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, with the terms that give it away."""
    found = personal_data.personal_spans(table(spark, sf_dir, "documents"))
    base, terms = personal_data.span_text(F.col("base")), personal_data.span_text(F.col("terms"), F.lit("term"))
    counts = [personal_data.kind_count(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(personal_data.KINDS)]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), _listed(base, terms).alias("spans"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of the documents; every third proof is checked against a tampered text."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_warc": op2_warc,
    "op3_bpe": op3_bpe,
    "op4_url_rules": op4_url_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_join": op6_ngram_join,
    "op7_mixing": op7_mixing,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality": op9_quality,
    "op10_token_files": op10_token_files,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_personal_data": op12_personal_data,
    "op13_manifest": op13_manifest,
}


def _crc32(text: str) -> str:
    """The CRC-32 of ASCII text as DuckDB SQL, bit by bit."""
    step = "list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    values = f"list_prepend(4294967295, list_transform(string_split({text}, ''), lambda d: CAST(ord(d) AS BIGINT)))"
    return f"xor(list_reduce({values}, lambda c, b: {step}), 4294967295)"


def _leaf(lower: bool = False) -> str:
    """The parts of a leaf's text as DuckDB SQL."""
    columns = {c: f"CAST({c} AS VARCHAR)" for c in merkle.FIELDS}
    if lower:
        columns["text"] = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return ", ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in columns.values())


_LANGS = ", ".join(f"'{w}'" for w in quality.STOP_LANGS)
_STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
SQL = {
    "op5_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, E' \t\n\x0B\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), common AS (
  SELECT k, max(doc_id) AS holder FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE holder IS NOT NULL AND holder <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE holder IS NULL OR holder = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN common USING (k) GROUP BY doc_id
""",
    "op6_ngram_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)
), reached AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT doc_id, y FROM reached JOIN links ON x = r
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY ALL
""",
    "op9_quality": rf"""
WITH parts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents
), runs AS (
  SELECT r, i, list_slice(w, i, i + 7) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM parts WHERE len(w) > 8)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM runs) WHERE c > 1
), covered AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r
), counted AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN ({_STOPS}))) AS stops,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper
  FROM parts LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•|]'))) AS bullets,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND word_chars / n_words BETWEEN 2.0 AND 12.0
    AND n_symbols / word_chars <= 0.05
    AND (lang IS NULL OR lower(split_part(split_part(lang, '-', 1), '_', 1)) NOT IN ({_LANGS}) OR stops / n_words >= 0.04)
    AND n_dup_lines / len(l) <= 0.4
    AND bullets / len(l) <= 0.9
    AND upper / word_chars <= 0.6 AS kept
FROM judged
""",
    "op11_prefix_trie": f"""
WITH own AS (
  SELECT conv_id, length_role || ':' || role || text AS w, octet_length(encode(text)) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length_role || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
          octet_length(encode(coalesce(role, ''))) AS length_role FROM conversations WHERE conv_id IS NOT NULL)
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)
), rebuilt AS (
  SELECT ids.conv_id, own.w, own.bytes, own.i FROM ids JOIN own ON own.conv_id = ids.base AND own.i <= ids.h
  UNION ALL SELECT ids.conv_id, own.w, own.bytes, own.i FROM ids JOIN own ON own.conv_id = ids.conv_id AND own.i > ids.h
), paths AS (
  SELECT ids.conv_id, coalesce(list(w ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS p,
    coalesce(list(bytes ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS b
  FROM ids LEFT JOIN rebuilt USING (conv_id) GROUP BY ids.conv_id
), members AS (
  SELECT conv_id, d, p[1:d] AS k, len(p) = d AS is_end, CASE WHEN d = 0 THEN 0 ELSE b[d] END AS bytes
  FROM (SELECT *, unnest(range(len(p) + 1)) AS d FROM paths)
), nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends
  FROM members GROUP BY k, d
), kids AS (
  SELECT k[1:d - 1] AS k, count(*) AS c FROM nodes WHERE d > 0 GROUP BY 1
), subtrees AS (
  SELECT k[1:a] AS k, count(*) FILTER (WHERE c = 0) AS leaves, sum((n - 1) * bytes) AS saved
  FROM (SELECT nodes.k, n, bytes, coalesce(c, 0) AS c, unnest(range(d + 1)) AS a FROM nodes LEFT JOIN kids USING (k)) GROUP BY 1
)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(c, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes JOIN subtrees USING (k) LEFT JOIN kids USING (k) LEFT JOIN nodes up ON up.k = nodes.k[1:nodes.d - 1] AND nodes.d > 0
""",
    "op13_manifest": f"""
WITH RECURSIVE rows_of AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 AS tampered,
    sha256(concat({_leaf()})) AS leaf, sha256(concat({_leaf(True)})) AS changed
  FROM documents
), leaves AS (
  SELECT *, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM rows_of
), lower_levels AS (
  SELECT g, 0 AS l, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM leaves
  UNION ALL SELECT g, l + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM lower_levels WHERE n > 1 GROUP BY g, l, n, i // 8
), tops AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i FROM lower_levels WHERE n = 1
), upper_levels AS (
  SELECT 0 AS l, i, subroot AS h, count(*) OVER () AS n FROM tops
  UNION ALL SELECT l + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM upper_levels WHERE n > 1 GROUP BY l, n, i // 8
), levels AS (
  SELECT g, l, i, h, n FROM lower_levels
), heights AS (
  SELECT g, max(l) AS top FROM levels GROUP BY g
), steps AS (
  -- Every run a proof passes: those of the language, then those of the tree above.
  SELECT r, lv.l AS step, string_agg(h, '' ORDER BY lv.i) FILTER (WHERE lv.i < x.i) AS before, string_agg(h, '' ORDER BY lv.i) FILTER (WHERE lv.i > x.i) AS after
  FROM (SELECT r, g, l, leaves.i // CAST(pow(8, l) AS BIGINT) AS i FROM leaves JOIN heights USING (g), LATERAL (SELECT unnest(range(top)) AS l)) x
  JOIN levels lv ON lv.g = x.g AND lv.l = x.l AND lv.i // 8 = x.i // 8 GROUP BY ALL
  UNION ALL
  SELECT r, 1000 + u.l, string_agg(h, '' ORDER BY u.i) FILTER (WHERE u.i < x.i), string_agg(h, '' ORDER BY u.i) FILTER (WHERE u.i > x.i)
  FROM (SELECT r, l, tops.i // CAST(pow(8, l) AS BIGINT) AS i FROM leaves JOIN tops USING (g), LATERAL (SELECT unnest(range((SELECT max(l) FROM upper_levels))) AS l)) x
  JOIN upper_levels u ON u.l = x.l AND u.i // 8 = x.i // 8 GROUP BY ALL
), proofs AS (
  SELECT leaves.r, coalesce(list({{'b': coalesce(before, ''), 'a': coalesce(after, '')}} ORDER BY step) FILTER (WHERE step IS NOT NULL), []) AS p
  FROM leaves LEFT JOIN steps USING (r) GROUP BY leaves.r
), folds AS (
  SELECT r, 0 AS s, CASE WHEN tampered THEN changed ELSE leaf END AS h, p FROM leaves JOIN proofs USING (r)
  UNION ALL SELECT r, s + 1, sha256(p[s + 1].b || h || p[s + 1].a), p FROM folds WHERE s < len(p)
), top AS (
  SELECT h AS root FROM upper_levels WHERE n = 1
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: x.b || x.a), '')) AS proof_sha256,
  h AS folded_root, h = root AS verified
FROM leaves JOIN tops USING (g) JOIN folds USING (r), top WHERE s = len(p)
""",
}
