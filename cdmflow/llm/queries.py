"""The registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmflow.llm import (
    centroids, decontaminate, hard_negatives, html_extract, langid, licenses, packing, pii, quality_rules, simhash,
    suffix_dedup, toxicity, url_filter)
from cdmflow.llm.common import held_out, table

# The rules that the URL query judges by.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP10_SQL = """
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT p.*, r.*, row_number() OVER (
           PARTITION BY page_id ORDER BY length(r_host || r_path) DESC NULLS LAST) AS rank
  FROM parts p LEFT JOIN rules r
    ON (p.host = r_host OR ends_with(p.host, '.' || r_host)) AND starts_with(p.path, r_path))
SELECT page_id, host, path, r_host || r_path AS rule, coalesce(r_verdict, 'allow') AS verdict
FROM fits WHERE rank = 1
"""

def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, CASE WHEN lang IN ('en', 'de', 'fr', 'es') THEN lang ELSE '' END AS stratum, coalesce(text, '') AS text
  FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x09-\x0D\x20]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x09-\x0D\x20]')) AS lines FROM t),
tri AS (
  SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS v
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS n FROM tri) WHERE n > 1)
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, stratum, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
         length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclamations,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN repeated USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (
  SELECT doc_id, stratum, base_failed,
         unnest([{'rule': 1, 'value': if(word_chars > 0, n_symbols / word_chars, 0)},
                 {'rule': 2, 'value': if(word_chars > 0, n_capitals / word_chars, 0)},
                 {'rule': 3, 'value': if(word_chars > 0, n_exclamations / word_chars, 0)},
                 {'rule': 4, 'value': if(n_words > 0, n_repeat_words / n_words, 0)},
                 {'rule': 5, 'value': if(n_lines > 0, n_dup_lines / n_lines, 0)}], recursive := true)
  FROM b),
l AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
h AS (
  SELECT v.doc_id, stratum, rule, value, quality > 0 AS good, substr(sha256(v.doc_id::VARCHAR), 1, 1) < '8' AS proposes
  FROM v JOIN l USING (doc_id) WHERE NOT base_failed),
balance AS (
  SELECT stratum, rule, c, count(*) FILTER (NOT good AND value > c) - 10 * count(*) FILTER (good AND value > c) AS balance
  FROM h, (SELECT unnest([0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.4, 0.5, 0.65, 0.8])::DOUBLE AS c)
  WHERE proposes GROUP BY stratum, rule, c),
proposed AS (
  SELECT stratum, rule, c, row_number() OVER (PARTITION BY stratum ORDER BY balance DESC, rule) AS place
  FROM (SELECT * FROM balance WHERE balance > 0
        QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY balance DESC, c DESC) = 1)),
hit AS (
  SELECT doc_id, stratum, min(place) FILTER (value > c) AS place
  FROM h LEFT JOIN proposed USING (stratum, rule) WHERE good AND NOT proposes GROUP BY doc_id, stratum),
tests AS (
  SELECT p.stratum, p.rule, p.c, p.place, count(*) AS n, count(*) FILTER (hit.place <= p.place) AS k
  FROM proposed p JOIN hit USING (stratum) GROUP BY ALL),
verdict AS (
  SELECT *, k < n * 0.05 AND
        list_sum(list_transform(range(0, k + 1), lambda i:
          exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)))) <= 0.05 / 5 AS passed
  FROM tests),
best AS (
  SELECT stratum, rule, c FROM verdict
  QUALIFY coalesce(min(place) FILTER (NOT passed) OVER (PARTITION BY stratum) > place, true)),
rejected AS (SELECT DISTINCT doc_id FROM v JOIN best USING (stratum, rule) WHERE value > c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM b
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.trained(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", "whole_license", F.array_join("licenses", ",").alias("licenses"))


_COPYRIGHT = r"^[ \t>#*/;-]*"
OP5_SQL = rf"""
WITH known(license, raw) AS (VALUES {", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in licenses.KNOWN)}),
unit AS (
  SELECT 'doc' AS kind, doc_id, NULL AS license, 0 AS part, coalesce(text, '') AS u FROM documents
  UNION ALL SELECT 'doc', doc_id, NULL, 1, unnest(regexp_split_to_array(coalesce(text, ''), '\n[ \t]*\n')) FROM documents
  UNION ALL SELECT 'doc', doc_id, NULL, 2, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents
  UNION ALL SELECT 'known', NULL, license, 0, raw FROM known),
plain AS (
  SELECT kind, doc_id, license, part, array_to_string(list_filter(string_split(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), chr(10)), lambda x: NOT (
             regexp_matches(x, '{_COPYRIGHT}(copyright[ \t:,]*(\(c\)|©|&copy;|[0-9<\[{{])|\(c\)[ \t]*(copyright|[0-9]{{4}})|©)')
             OR regexp_matches(x, '{_COPYRIGHT}copyright[ \t:,]*[^\s.,;:)]')
                AND NOT regexp_matches(x, '{_COPYRIGHT}copyright[ \t:,]*(notices?|holders?|owners?|laws?|licen[cs]es?|statements?|interests?|treat(y|ies)|rights?|disclaimer|protection|and|or|to|in|of|on|for|is|as|under|the (work|software|program|library))\b'))),
           chr(10)) AS c
  FROM unit),
form AS (
  SELECT kind, doc_id, license, part, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(c,
           'licence', 'license'), 'licenced', 'licensed'), 'sub-license', 'sublicense'),
           'non-commercial', 'noncommercial'), 'merchantibility', 'merchantability'), 'http://', 'https://'),
           '&', ' and '), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') AS c
  FROM plain),
text AS (SELECT c, min(license) AS license FROM form WHERE kind = 'known' AND c <> '' GROUP BY c),
stated AS (
  SELECT doc_id, unnest(regexp_extract_all(regexp_replace(e, '(?i)[ \t]+WITH[ \t]+[(]*[A-Za-z0-9.+-]+', '', 'g'),
                                           '[A-Za-z0-9][A-Za-z0-9.+-]*')) AS license
  FROM (SELECT doc_id, unnest(regexp_extract_all(text,
          '(?i)SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*)*)',
          1)) AS e FROM documents)),
inside AS (
  SELECT DISTINCT doc_id, text.c, text.license FROM form JOIN text ON contains(' ' || form.c || ' ', ' ' || text.c || ' ')
  WHERE kind = 'doc' AND part = 0),
hit AS (
  SELECT doc_id, text.license FROM form JOIN text USING (c) WHERE kind = 'doc'
  UNION SELECT doc_id, license FROM inside i WHERE NOT EXISTS (
    FROM inside j WHERE j.doc_id = i.doc_id AND length(j.c) > length(i.c) AND contains(' ' || j.c || ' ', ' ' || i.c || ' '))
  UNION SELECT doc_id, license FROM stated WHERE upper(license) NOT IN ('AND', 'OR')),
named AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses FROM hit GROUP BY doc_id)
SELECT doc_id, sha256(form.c) AS digest, text.license AS whole_license, coalesce(licenses, '') AS licenses
FROM form LEFT JOIN text USING (c) LEFT JOIN named USING (doc_id) WHERE kind = 'doc' AND part = 0
"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
gram AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[s:s + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
place AS (
  SELECT doc_id, z.size, s, array_to_string(w[s:s + z.size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM d, (SELECT DISTINCT size FROM gram) sizes) z),
hit AS (SELECT doc_id, s, place.size, item_id FROM place JOIN gram USING (phrase, size)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


PII_KEY = "key of the registered query"


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, count_col="n_replaced")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model, out_col="score")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(every % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, every % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n
  ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs, min_length=200, keep_first=False)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, scale=1024, seed=3)


_ROUND = """
a{i} AS MATERIALIZED (
  SELECT vec_id, q, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT vec_id, q, c, list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM v, c{i})
  GROUP BY vec_id, q),
c{j} AS MATERIALIZED (
  SELECT c, coalesce(n.m, o.m) AS m
  FROM c{i} o LEFT JOIN (
    SELECT c, list(x ORDER BY j) AS m
    FROM (SELECT c, j, floor(sum(q[j]) / count(*)) AS x FROM a{i}, (SELECT unnest(range(1, 65)) AS j) GROUP BY c, j)
    GROUP BY c) n USING (c))"""
OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, q AS m FROM v ORDER BY sha256('3:' || vec_id) LIMIT 8),
""" + ",".join(_ROUND.format(i=i, j=i + 1) for i in range(11)) + """
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(m, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a10 a JOIN c10 USING (c)
"""

QUERIES = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_language": op3_language,
    "op4_html": op4_html,
    "op5_licenses": op5_licenses,
    "op6_decontaminate": op6_decontaminate,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_url_filter": op10_url_filter,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_centroids": op13_centroids,
}
ORACLE = {
    "op1_quality": OP1_SQL,
    "op5_licenses": OP5_SQL,
    "op6_decontaminate": OP6_SQL,
    "op10_url_filter": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_centroids": OP13_SQL,
}
