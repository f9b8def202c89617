"""Queries opN_<name> and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontaminate, html_extract, language_id, ngram_join, packing, pii, secrets_scan, substring_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_html": html_extract.op2_html,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_secrets": secrets_scan.op4_secrets,
    "op5_language": language_id.op5_language,
    "op6_nearest": ann.op6_nearest,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_pii": pii.op8_pii,
    "op9_near_duplicates": ngram_join.op9_near_duplicates,
    "op10_pack": packing.op10_pack,
}
ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, k, array_to_string(ws[k:k + 49], ' ') AS g FROM w, unnest(range(1, len(ws) - 48)) t(k)),
firsts AS (SELECT g, min(doc_id) AS f FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, k + j AS p FROM (SELECT doc_id, k FROM windows JOIN firsts USING (g) WHERE f < doc_id), range(0, 50) t(j)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op7_decontaminate": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(ws)) AS n, array_to_string(ws[k:k + least(10, len(ws)) - 1], ' ') AS g FROM items, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) t(k) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
found AS (SELECT doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') AS g FROM w, sizes, unnest(range(1, len(ws) - n + 2)) t(k)),
hits AS (SELECT doc_id, k, n, item FROM found JOIN windows USING (n, g)),
hit_words AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM (SELECT DISTINCT doc_id, k, n FROM hits), range(0, 10) t(j) WHERE j < n GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op9_near_duplicates": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + least(5, len(ws)) - 1], ' ') AS g FROM w, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) t(k) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_sides FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * both_sides >= 80 * (s.n + t.n - both_sides)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id FROM reach LEFT JOIN sizes ON sizes.doc_id = a GROUP BY a""",
}
