"""Registered queries of the subpackage, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.llm import (ann, chat, divergence, fingerprint, lattice, mixing, ngram_join, packing, prefix_trie, suffix_dedup, toxicity, url_filter,
                          warc)
from tickmart.llm.scratch import fresh_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


def op2_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page is archived below the shared folder and read back."""
    path = fresh_path(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The rules of the URL query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, folder, "pages"), rules)


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_likeness(table(spark, folder, "documents"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, folder, "documents"))


def op7_length_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_batches(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


#: A conversation that says its own control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    turns = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").union(own)
    return chat.digests(chat.formatted(turns.withColumn("parts", chat.text_part(F.col("text")))))


def op11_lattice_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, folder, "conversations"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(table(spark, folder, "documents"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_warc_archive": op2_warc_archive,
    "op3_url_filter": op3_url_filter,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_fingerprints": op5_fingerprints,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_length_packing": op7_length_packing,
    "op8_toxicity": op8_toxicity,
    "op9_source_mixing": op9_source_mixing,
    "op10_chat_format": op10_chat_format,
    "op11_lattice_dedup": op11_lattice_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_divergence": op13_source_divergence,
}

_OP1 = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE
          WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM t),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.8),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
grp AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
deg AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT s.doc_id, class_id, CASE WHEN len(g) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY g) END AS copy_of,
       coalesce(deg.n, 0) AS n_links, CAST(len(g) AS INTEGER) AS n_shingles
FROM s JOIN grp USING (doc_id) LEFT JOIN deg USING (doc_id)
"""

_OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT *, strlen(h) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY h) AS again, min(page_id) OVER (PARTITION BY h) AS holder FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN holder END AS refers_to
FROM r
"""

_OP3 = """
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
hits AS (SELECT DISTINCT host, path, first(h || p ORDER BY len(h) DESC, len(p) DESC) OVER w AS rule, first(v ORDER BY len(h) DESC, len(p) DESC) OVER w AS verdict
         FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
         WINDOW w AS (PARTITION BY host, path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN hits USING (host, path)
"""

_OP9 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(source), '') || ':' || md5(coalesce(text, ''))) AS key,
                  row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS copy FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w FROM d GROUP BY source),
o AS (SELECT *, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS b, sum(w) OVER () AS wall,
             coalesce(sum(2 * source_size) OVER k, 0) AS capped_before, coalesce(sum(w) OVER k, 0) AS w_before
      FROM s WINDOW k AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * (wall - w_before) <= w * (b - capped_before) AS is_full FROM o),
l AS (SELECT max(b) - coalesce(CAST(sum(cap) FILTER (is_full) AS DOUBLE), 0) AS rest, CAST(sum(w) FILTER (NOT is_full) AS DOUBLE) AS free FROM f),
t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE w * rest / free END AS target FROM f, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
c AS (SELECT d.*, source_size, target, rate, CAST(floor(rate) AS BIGINT) + CASE WHEN CAST('0x' || substr(md5('9:' || key || ':' || CAST(copy AS VARCHAR)), 1, 13) AS BIGINT)
             / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, source, size, source_size, target, rate, CAST(copies AS BIGINT) AS copies, CAST(copies * size AS BIGINT) AS taken FROM c
"""

_OP10 = r"""
WITH c AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(15 + length(role) + length(text) + length(regexp_replace(text, '[^\\<]', '', 'g'))) AS n FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(n AS BIGINT) AS formatted_chars FROM g
"""

_OP11 = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
v AS (SELECT r, vec_id, label, list_transform(x, lambda c: c / sqrt(list_sum(list_transform(x, lambda d: d * d)))) AS u FROM e
      WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.u) = len(b.u)
          WHERE list_dot_product(a.u, b.u) >= 0.93),
reach AS (SELECT r AS a, r AS b FROM e UNION SELECT x.a, l.b FROM reach x JOIN links l ON x.b = l.a),
grp AS (SELECT reach.a AS r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY reach.a),
deg AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(deg.n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM e JOIN grp USING (r) LEFT JOIN deg USING (r)
"""

_OP12 = """
WITH t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS n,
                  sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
           FROM conversations WHERE conv_id IS NOT NULL),
w AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(n ORDER BY turn NULLS FIRST, k) AS ns,
             list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT)) AS letters FROM t GROUP BY conv_id),
c AS (SELECT conv_id, ks, ns, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, letters), lambda a, b:
             list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) % 6 AS h FROM w),
p AS (SELECT c.conv_id, coalesce(b.ks[1:h], []) || c.ks[h + 1:] AS ks, coalesce(b.ns[1:h], []) || c.ns[h + 1:] AS ns FROM c LEFT JOIN w b ON b.conv_id = c.base),
m AS (SELECT conv_id, ks, ns, unnest(range(0, len(ks) + 1)) AS depth FROM p),
g AS (SELECT array_to_string(ks[1:depth], ',') AS name, depth, min(conv_id) AS conv_id, count(*) AS n_convs, first(ks[1:depth]) AS pre,
             coalesce(first(ns[depth]), 0) AS n, CASE WHEN depth > 0 THEN first(array_to_string(ks[1:depth - 1], ',')) END AS parent,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(ks) = depth), '')) AS ends_sha256
      FROM m GROUP BY name, depth),
k AS (SELECT parent AS name, count(*) AS n FROM g WHERE depth > 0 GROUP BY parent),
a AS (SELECT unnest(list_transform(range(0, g.depth + 1), lambda i: array_to_string(pre[1:i], ','))) AS name,
             CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * g.n AS gain FROM g LEFT JOIN k USING (name)),
s AS (SELECT name, sum(leaf) AS n_leaves, sum(gain) AS saved FROM a GROUP BY name)
SELECT g.conv_id, g.depth, up.conv_id AS parent_conv_id, g.n_convs, coalesce(k.n, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g LEFT JOIN g up ON up.name = g.parent LEFT JOIN k ON k.name = g.name JOIN s ON s.name = g.name
"""

_OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM u GROUP BY lang, source, term),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, sum(c.n) AS n FROM c JOIN k USING (lang, term) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, CAST(1 + 1000000000 * (coalesce(c.n, 0) + 1) // (coalesce(s.n, 0) + v.v) AS BIGINT) AS p,
             CAST(1 + 1000000000 * (k.n + 1) // (v.n + v.v) AS BIGINT) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT g.lang, g.source, o.source AS item, coalesce(x.value, 0) AS value FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
          LEFT JOIN (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
                     FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source) x
          ON x.lang = g.lang AND x.source = g.source AND x.item = o.source),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
               UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM both_parts)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200
"""

ORACLE_SQL = {
    "op1_ngram_jaccard": _OP1,
    "op2_warc_archive": _OP2,
    "op3_url_filter": _OP3,
    "op9_source_mixing": _OP9,
    "op10_chat_format": _OP10,
    "op11_lattice_dedup": _OP11,
    "op12_prefix_trie": _OP12,
    "op13_source_divergence": _OP13,
}
