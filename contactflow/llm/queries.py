"""Registered queries of the training-data operators, with production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import (
    decontamination,
    exact_dedup,
    filter_audit,
    language_id,
    prefix_trie,
    quality,
    segmentation,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_counts,
    url_filter,
    warc,
)
from .common import id_bucket, read_documents

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024
#: Segmentations drawn per document.
DRAWS = 2
SEED = 7
PREDICT_AT = 0.3
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


@query
def op1_language_id(spark, sf_dir):
    """Language of each document, learned from those outside the held-out fold."""
    docs = read_documents(spark, sf_dir)
    model = language_id.train(docs.where(id_bucket(4) != 2))
    found = language_id.identify(spark, docs, model)
    return found.select("doc_id", (id_bucket(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op2_substring_dedup(spark, sf_dir):
    """Words that stay when runs of 50 words from earlier documents are removed."""
    found = substring_dedup.deduplicate(spark, read_documents(spark, sf_dir))
    return found.select("doc_id", F.col("total").alias("n_words"), F.col("removed").alias("n_removed"), "kept_sha256")


@query
def op3_quality_classifier(spark, sf_dir):
    """Quality score of each document, learned from labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored, _ = quality.score_quality(spark, read_documents(spark, sf_dir), labels.where(id_bucket(5) != 0))
    predicted = (F.col("score") >= PREDICT_AT).cast("int")
    return scored.select("doc_id", (id_bucket(5) == 0).alias("held_out"), "score", predicted.alias("predicted"))


@query
def op4_suffix_array_dedup(spark, sf_dir):
    """Bytes that stay when strings of 50 bytes from earlier documents are removed."""
    found = suffix_dedup.deduplicate(spark, read_documents(spark, sf_dir))
    return found.select(
        "doc_id", F.col("total").alias("n_bytes"), F.col("removed").alias("n_removed"), "n_spans", "kept_sha256"
    )


@query
def op5_sentencepiece(spark, sf_dir):
    """Sampled segmentations of each document: size, scores, hash of the pieces, and whether they read back."""
    docs = read_documents(spark, sf_dir)
    found = segmentation.sample_segmentations(docs, PIECES, DRAWS, SEED)
    return segmentation.summary(found)


@query
def op6_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and class of each document."""
    found = simhash.near_duplicates(spark, read_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item, with the item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contaminated(spark, read_documents(spark, sf_dir), items)
    return found.select("doc_id", "item_id", F.col("shared").cast("long").alias("shared"), F.col("total").cast("long").alias("total"))


@query
def op8_exact_dedup(spark, sf_dir):
    """Group of equal normalised texts of each document, and which row stays."""
    found = exact_dedup.deduplicate(spark, read_documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query
def op9_url_filters(spark, sf_dir):
    """Verdict on each page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    found = url_filter.judge(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query
def op10_token_counts(spark, sf_dir):
    """Tokens of each document."""
    return token_counts.count_tokens(read_documents(spark, sf_dir), TOKENIZER, TOKEN_LIMIT)


@query
def op11_filter_audit(spark, sf_dir):
    """Outcome of every step of all orders of five filters, per language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(spark, read_documents(spark, sf_dir), labels)


@query
def op12_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op13_warc(spark, sf_dir):
    """Record of each page, as read back from the archives."""
    found = warc.archive_pages(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2 = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 48)) AS s, w FROM d WHERE len(w) >= 50),
runs AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 49), ' ') AS t FROM win),
firsts AS (SELECT t, min(doc_id) AS first FROM runs GROUP BY t),
gone AS (SELECT DISTINCT r.doc_id, unnest(range(r.s, r.s + 50)) AS i
  FROM runs r JOIN firsts f USING (t) WHERE f.first < r.doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT w.doc_id, count(*) AS n, string_agg(w.x, ' ' ORDER BY w.i) AS t
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i WHERE g.i IS NULL GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n
  FROM documents),
runs AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS t
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS s FROM d WHERE n >= 50)),
firsts AS (SELECT t, min(doc_id) AS first FROM runs GROUP BY t),
starts AS (SELECT r.doc_id, r.s FROM runs r JOIN firsts f USING (t) WHERE f.first < r.doc_id),
chained AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS opens
  FROM starts),
numbered AS (SELECT doc_id, s, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM chained),
spans AS (SELECT doc_id, span, min(s) AS lo, max(s) + 50 AS hi FROM numbered GROUP BY doc_id, span),
edges AS (
  SELECT doc_id, hi AS lo, lead(lo) OVER (PARTITION BY doc_id ORDER BY lo) AS hi FROM spans
  UNION ALL SELECT doc_id, 0, min(lo) FROM spans GROUP BY doc_id),
kept AS (
  SELECT e.doc_id, string_agg(substr(h, 2 * e.lo + 1, 2 * (coalesce(e.hi, n) - e.lo)), '' ORDER BY e.lo) AS h
  FROM edges e JOIN d USING (doc_id) GROUP BY e.doc_id),
sums AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

OP7 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
item_words AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
items AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS g
  FROM (SELECT item_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS s
        FROM item_words WHERE len(w) > 0)),
totals AS (SELECT item_id, count(*) AS total FROM items GROUP BY item_id),
spans AS (SELECT DISTINCT k FROM items),
shingles AS (
  SELECT DISTINCT doc_id, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM docs, spans WHERE len(w) >= k)),
shared AS (SELECT doc_id, item_id, count(*) AS shared FROM shingles JOIN items USING (k, g) GROUP BY ALL)
SELECT doc_id, item_id, shared, total FROM shared JOIN totals USING (item_id)
WHERE 5 * shared >= 4 * total
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP9 = r"""
WITH RECURSIVE rest AS (
  SELECT page_id, html,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages),
rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
  SELECT page_id, html, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(r, '^[^/?#]*([^#]*)', 1) AS tail
  FROM rest),
links AS (
  SELECT host || tail AS a, host, path, unnest([
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)]) AS link
  FROM parts WHERE host <> ''),
targets AS (
  SELECT a, CASE WHEN instr(link, '://') > 0 THEN substr(link, instr(link, '://') + 3)
    WHEN starts_with(link, '//') THEN substr(link, 3) WHEN starts_with(link, '/') THEN host || link
    ELSE host || regexp_replace('/' || path, '^/(.*?)[^/]*$', '\1') || link END AS r
  FROM links WHERE link <> ''),
edges AS (
  SELECT a, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(r, '^[^/?#]*([^#]*)', 1) AS b FROM targets),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a),
nodes AS (
  SELECT DISTINCT b, regexp_extract(b, '^[^/?#]*') AS host, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
all_urls AS (SELECT DISTINCT host, path FROM parts UNION SELECT host, path FROM nodes),
ruled AS (
  SELECT u.host, u.path, max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, action := action)) AS best
  FROM all_urls u JOIN rules r ON (u.host = rule_host OR ends_with(u.host, '.' || rule_host)) AND starts_with(u.path, rule_path)
  GROUP BY u.host, u.path),
blocked AS (
  SELECT DISTINCT reach.a FROM reach JOIN nodes USING (b) JOIN ruled USING (host, path) WHERE best.action = 'block')
SELECT page_id, p.host, p.path, best.rule AS rule,
  coalesce(best.action, CASE WHEN b.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM parts p LEFT JOIN ruled r ON p.host = r.host AND p.path = r.path LEFT JOIN blocked b ON b.a = p.host || p.tail
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    coalesce((SELECT bool_or(quality = 1) FROM labels l WHERE l.doc_id = documents.doc_id), false) AS good,
    coalesce((SELECT bool_or(toxic = 1) FROM labels l WHERE l.doc_id = documents.doc_id), false) AS toxic
  FROM documents),
failed AS (
  SELECT part, good, toxic, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d),
masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (
  SELECT filter_order, i AS step, substr(filter_order, i, 1) AS f, substr(filter_order, 1, i - 1) AS earlier
  FROM orders, range(1, 6) r(i)),
outcome AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails = f AS only_this, contains(fails, f) AS fails_here,
    earlier <> '' AND translate(fails, earlier, '') <> fails AS gone
  FROM steps, masks),
counted AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails_here), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails_here), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND fails_here), 0) AS redundant,
    coalesce(sum(n) FILTER (only_this), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails_here), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fails_here), 0) AS toxic_lost
  FROM outcome GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

#: DuckDB has no crc32: it is a fold over the bits of the id's digits (fixed value: the reversed polynomial of CRC-32).
OP12 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id FROM conversations),
convs AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(length(text) ORDER BY turn NULLS FIRST, id) AS sizes
  FROM turns GROUP BY conv_id),
crc AS (
  SELECT conv_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS x
  FROM convs),
opened AS (
  SELECT c.conv_id, c.ids, c.sizes, coalesce(xor(x, 4294967295) % 6, 0) AS h,
    coalesce(b.ids, []) AS base_ids, coalesce(b.sizes, []) AS base_sizes
  FROM convs c JOIN crc ON c.conv_id IS NOT DISTINCT FROM crc.conv_id LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100),
built AS (
  SELECT conv_id, list_slice(base_ids, 1, h) || list_slice(ids, h + 1, len(ids)) AS ids,
    list_slice(base_sizes, 1, h) || list_slice(sizes, h + 1, len(sizes)) AS sizes
  FROM opened),
pre AS (
  SELECT conv_id, d, list_slice(ids, 1, d) AS p, list_slice(ids, 1, d - 1) AS up, len(ids) = d AS ended,
    CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM built)),
nodes AS (
  SELECT p, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(coalesce(CAST(conv_id AS VARCHAR), ''), ',' ORDER BY conv_id NULLS LAST) FILTER (ended), '')) AS ends_sha256
  FROM pre GROUP BY p, d),
kids AS (SELECT up AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
paths AS (
  SELECT n.p, (n.n_convs - 1) * n.size AS saved, CASE WHEN k.p IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, n.d + 1)) AS a
  FROM nodes n LEFT JOIN kids k USING (p)),
sums AS (SELECT list_slice(p, 1, a) AS p, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM paths GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes u ON n.d > 0 AND u.p = n.up LEFT JOIN kids k ON k.p = n.p JOIN sums s ON s.p = n.p
"""

OP13 = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN n >= 100 AND first < coalesce(page_id, 9223372036854775807) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first < coalesce(page_id, 9223372036854775807) THEN first END AS refers_to
FROM f
"""

ORACLES: dict[str, str] = {
    "op11_filter_audit": OP11,
    "op12_prefix_trie": OP12,
    "op13_warc": OP13,
    "op2_substring_dedup": OP2,
    "op4_suffix_array_dedup": OP4,
    "op7_benchmark_decontamination": OP7,
    "op8_exact_dedup": OP8,
    "op9_url_filters": OP9,
}
