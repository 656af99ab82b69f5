"""Registered queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.llm import (
    bpe,
    decontaminate,
    exact_search,
    html_text,
    language_id,
    nearest,
    personal,
    prefix_trie,
    quality,
    secrets,
    simhash,
    warc,
    whitening,
)
from settle.llm.common import table

ORACLES: dict[str, str] = {}


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"), ["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    every = F.array_sort(F.concat("_base", "_live"))
    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.KINDS],
        F.sha2(secrets.joined(F.col("_base")), 256).alias("base_sha256"),
        secrets.joined(every).alias("spans"),
        F.size("_live").cast("bigint").alias("n_live"),
        F.col("_n_copied").alias("n_copied"),
        F.col("_n_owners").alias("n_owners"),
        F.col("_n_repositories").alias("n_repositories"),
    )


# Starts follow from the lengths of the pieces between the matches.
ORACLES["op1_secret_scan"] = r"""
WITH pat(kind, rank, p) AS (VALUES
  ('assign', 0, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 'AKIA[A-Z0-9]+'), ('hex', 2, '[0-9a-f]+')),
doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '<null>') AS source, coalesce(text, '') AS text FROM documents),
cut AS (SELECT rid, kind, rank, p, m, string_split_regex(text, p) AS g
  FROM (SELECT *, regexp_extract_all(text, p) AS m FROM doc, pat) WHERE len(m) > 0),
each AS (SELECT rid, kind, rank, p, unnest(m) AS m, unnest(g[:len(m)]) AS g, unnest(range(len(m))) AS i FROM cut),
placed AS (SELECT rid, kind, rank, m, CASE kind WHEN 'assign' THEN regexp_extract(m, p, 2) ELSE m END AS v,
  sum(length(g) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS e FROM each),
base AS (SELECT rid, kind, rank, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, v FROM placed
  WHERE length(v) >= CASE kind WHEN 'assign' THEN 12 WHEN 'access' THEN 18 ELSE 16 END),
owners AS (SELECT v, count(DISTINCT source) AS n, count(DISTINCT (source, doc_id)) AS r FROM base JOIN doc USING (rid) GROUP BY v),
live AS (SELECT DISTINCT rid, 'live' AS kind, 3 AS rank, e - length(v) AS s, e
  FROM base JOIN owners USING (v) WHERE n <= 3 AND r <= 25 AND len(list_distinct(string_split(v, ''))) >= 8),
per AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (n > 3 OR r > 25) AS n_copied, max(n) AS n_owners, max(r) AS n_repositories,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS joined
  FROM base JOIN owners USING (v) GROUP BY rid),
al AS (SELECT rid, count(*) FILTER (kind = 'live') AS n_live,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans
  FROM (SELECT rid, kind, rank, s, e FROM base UNION ALL SELECT * FROM live) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(joined, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied, coalesce(n_owners, 0) AS n_owners, coalesce(n_repositories, 0) AS n_repositories
FROM doc LEFT JOIN per USING (rid) LEFT JOIN al USING (rid)"""


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.findings(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        F.col("_match_n_words").alias("n_words"),
        F.col("_match_n_hit").alias("n_hit"),
        F.size("_match_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_match_items", ","), 256).alias("items_sha256"),
        F.col("_match_contaminated").alias("contaminated"),
        F.col("_match_longest").cast("bigint").alias("longest"),
        F.col("_match_longest_start").cast("bigint").alias("longest_start"),
        F.col("_match_longest_item").alias("longest_item"),
    )


# Words by place; windows of every length that items have; a word is hit if a
# window that occurs begins at most its length before it. Longest matches: pairs of
# words that a document and an item share lie on a diagonal, and a run of them
# without a gap is a match of one word more; single words count where no pair does.
ORACLES["op5_decontaminate"] = """
WITH item AS (
  SELECT item_id, w AS words, least(len(w), 13) AS k
  FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, words, k, unnest(range(1, CAST(len(words) - k + 2 AS BIGINT))) AS i FROM item)),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words FROM documents),
spot AS (
  SELECT rid, k, i, array_to_string(words[i:i + k - 1], ' ') AS win
  FROM (SELECT rid, words, k, unnest(range(1, CAST(len(words) - k + 2 AS BIGINT))) AS i
        FROM doc, (SELECT DISTINCT k FROM item) WHERE len(words) >= k)),
hit AS (SELECT rid, k, i, item_id FROM spot JOIN win USING (k, win)),
word AS (SELECT rid, count(*) AS n FROM
  (SELECT DISTINCT rid, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT rid, k, i FROM hit)) GROUP BY rid),
its AS (SELECT rid, list(DISTINCT CAST(item_id AS VARCHAR) ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY rid),
line AS (SELECT row_number() OVER () AS iid, CAST(item_id AS VARCHAR) AS item_id, words FROM item),
two AS (SELECT iid, j, words[j] AS a, words[j + 1] AS b FROM (SELECT iid, words, unnest(range(1, len(words))) AS j FROM line)),
pair AS (SELECT rid, i, words[i] AS a, words[i + 1] AS b FROM (SELECT rid, words, unnest(range(1, len(words))) AS i FROM doc)),
along AS (SELECT rid, iid, i, i - j AS diagonal, i - row_number() OVER (PARTITION BY rid, iid, i - j ORDER BY i) AS part
  FROM pair JOIN two USING (a, b)),
one AS (SELECT word, min(item_id) AS item_id FROM (SELECT item_id, unnest(words) AS word FROM line) GROUP BY word),
runs AS (SELECT rid, item_id, count(*) + 1 AS n, min(i) - 1 AS start FROM along JOIN line USING (iid) GROUP BY rid, iid, item_id, diagonal, part
  UNION ALL SELECT rid, item_id, 1, i - 1 FROM (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM doc) JOIN one USING (word)),
best AS (SELECT rid, n AS longest, start AS longest_start, item_id AS longest_item FROM runs
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY n DESC, start, item_id NULLS LAST) = 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256,
  coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(words) AS contaminated,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest, CAST(longest_start AS BIGINT) AS longest_start, longest_item
FROM doc LEFT JOIN word USING (rid) LEFT JOIN its USING (rid) LEFT JOIN best USING (rid)"""


def token_digests(encoded: DataFrame, vocabulary: bpe.Vocabulary) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to; decodes them unless that is done."""
    decoded = encoded if "decoded" in encoded.columns else bpe.decode(encoded, vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    index, files = warc.archive(table(spark, folder, "pages"))
    return warc.read_records(index, files, payloads=False).select(
        F.expr("try_cast(record_id AS bigint)").alias("page_id"),
        F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.expr("try_cast(refers_to AS bigint)").alias("refers_to"),
    )


ORACLES["op6_warc"] = """
WITH page AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
  sha1(coalesce(html, '')) AS payload_digest FROM pages),
big AS (SELECT payload_digest, max(page_id) AS largest FROM page WHERE payload_bytes >= 1000 GROUP BY payload_digest),
told AS (SELECT page.*, CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest THEN largest END AS refers_to
  FROM page LEFT JOIN big USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM told"""


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op10_personal(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find(table(spark, folder, "documents"), ["doc_id"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*personal.BASE))
    return found.select(
        "doc_id",
        *[count(kind) for kind in personal.BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    found = nearest.nearest(rows, F.col("vec_id") % 20 == 0, 20, "vec_id", "embedding")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def multilingual() -> bpe.Vocabulary:
    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = multilingual()
    return token_digests(bpe.round_trip(table(spark, folder, "documents"), vocabulary, ["doc_id"]), vocabulary)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"), "vec_id", "embedding")


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    found = exact_search.top_k(rows, F.col("vec_id") % 20 == 0, 20, "vec_id", "embedding")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


# A score is summed from the products of places that both vectors have. Integers
# beyond a long do not occur in the tables SQL is run on.
ORACLES["op12_exact_top_k"] = """
WITH part AS (SELECT row_number() OVER () AS rid, CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
valid AS (SELECT rid, vec_id, list_transform(v, lambda c: CAST(floor(64 * c) AS BIGINT)) AS x FROM part
  WHERE len(list_filter(v, lambda c: c IS NULL OR isnan(c) OR isinf(64 * c))) = 0),
cell AS (SELECT rid, vec_id, generate_subscripts(x, 1) AS d, unnest(x) AS v FROM valid),
score AS (SELECT q.rid AS own, c.rid, sum(q.v * c.v) AS score
  FROM cell q JOIN cell c ON q.d = c.d WHERE q.vec_id % 20 = 0 AND q.rid <> c.rid GROUP BY q.rid, c.rid),
pair AS (SELECT q.rid AS own, q.vec_id AS query_id, c.rid, c.vec_id, CAST(coalesce(s.score, 0) AS BIGINT) AS score
  FROM valid q JOIN valid c ON q.vec_id % 20 = 0 AND q.rid <> c.rid
  LEFT JOIN score s ON s.own = q.rid AND s.rid = c.rid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id, rid) AS rank FROM pair)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20"""


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_nodes(prefix_trie.borrowed_heads(table(spark, folder, "conversations")))


# CRC-32 bit by bit: a byte is mixed in at every eighth step.
ORACLES["op13_prefix_trie"] = r"""
WITH said AS (SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT c, dense_rank() OVER (ORDER BY role, text) AS t, text, row_number() OVER (PARTITION BY c
    ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text)) AS i FROM said),
words AS (SELECT DISTINCT t, len(regexp_extract_all(text, '[^ 	-
]+')) AS n FROM numbered),
conv AS (SELECT c, list(t ORDER BY i) AS ts, CAST(c AS VARCHAR) AS s FROM numbered GROUP BY c),
part AS (SELECT c, ts, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, len(s) + 1),
    lambda i: [CAST(ascii(substr(s, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1)))) % 4 AS h FROM conv),
seq AS (SELECT p.c, list_concat(coalesce(s.ts[1:p.h], []), p.ts[p.h + 1:]) AS ts
  FROM part p LEFT JOIN conv s ON s.c = p.c - p.c % 20),
member AS (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM seq),
node AS (SELECT ts[1:d] AS p, d, min(c) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(ts) = d), '')) AS ends FROM member GROUP BY ts[1:d], d),
child AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY p[1:d - 1]),
worth AS (SELECT node.p, node.d, CASE WHEN node.d = 0 THEN 0 ELSE (node.n - 1) * words.n END AS saved, child.n IS NULL AS leaf
  FROM node LEFT JOIN words ON words.t = node.p[node.d] LEFT JOIN child ON child.p = node.p),
above AS (SELECT p[1:k] AS p, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves
  FROM (SELECT p, saved, leaf, unnest(range(0, d + 1)) AS k FROM worth) GROUP BY p[1:k])
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs,
  coalesce(child.n, 0) AS n_children, above.leaves AS n_leaves, CAST(above.saved AS BIGINT) AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN above ON above.p = node.p LEFT JOIN child ON child.p = node.p
LEFT JOIN node parent ON node.d > 0 AND parent.p = node.p[1:node.d - 1]"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_warc": op6_warc,
    "op7_html_text": op7_html_text,
    "op8_nearest": op8_nearest,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_personal": op10_personal,
    "op11_whitening": op11_whitening,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_prefix_trie": op13_prefix_trie,
}
