"""The corpus operators as named queries over whole tables, and SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparring.llm import (
    ann,
    bpe,
    chat_format,
    decontaminate,
    jaccard_join,
    language_id,
    line_dedup,
    phrases,
    quality_crf,
    substring_dedup,
    token_alignment,
    toxicity,
    url_rules,
)
from sparring.llm.common import table
from sparring.session import local_frame

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digests(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.predict_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.shingle_components(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search_twentieths(table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


#: (host, path, action)
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = local_frame(spark, URL_RULES, "host string, path string, action string")
    return url_rules.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.alignment_digests(table(spark, sf_dir, "documents"), *paths)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_toxicity,
        op3_substring_dedup,
        op4_quality,
        op5_line_dedup,
        op6_chat_format,
        op7_jaccard_join,
        op8_bpe,
        op9_nearest,
        op10_language_id,
        op11_url_rules,
        op12_token_alignment,
        op13_phrases,
    )
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, r.keeper IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SUBSTRINGS = """
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(words[pos : pos + 12], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM split)
), first AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY run) AS first_doc FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM first WHERE first_doc < doc_id
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split
), kept AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.pos) AS n_removed,
         string_agg(word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL) AS text
  FROM words w LEFT JOIN gone g USING (doc_id, pos) GROUP BY w.doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept k USING (doc_id)
"""

CHATS = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER w - 1 AS place,
         '<|' || coalesce(role, 'user') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10) AS one,
         coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n') || chr(2) AS exact
  FROM conversations WHERE conv_id IS NOT NULL
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
), prefixes AS (
  SELECT conv_id, place, md5(string_agg(exact, '') OVER (PARTITION BY conv_id ORDER BY place)) AS run,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM turns
), whole AS (
  SELECT run, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns FROM prefixes WHERE place = n_turns - 1 GROUP BY run
), kept AS (
  SELECT * FROM whole WHERE run NOT IN (SELECT run FROM prefixes WHERE place < n_turns - 1)
)
SELECT conv_id, n_turns, place // 256 AS part, string_agg(one, '' ORDER BY place) AS text
FROM turns JOIN kept USING (conv_id) GROUP BY ALL
"""

COMPONENTS = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 4], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS pos FROM split WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
FROM reached r LEFT JOIN sizes s USING (doc_id) GROUP BY r.doc_id
"""

URLS = f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces
), sizes AS (
  SELECT lang, sum(len(words)) AS n FROM split GROUP BY lang
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM split
), runs AS (
  SELECT lang, size, array_to_string(words[pos : pos + size - 1], ' ') AS phrase
  FROM starts, range(1, 5) AS s(size) WHERE pos + size - 1 <= len(words)
), counts AS (
  SELECT lang, phrase, size, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30
), covered AS (
  SELECT c.lang, c.phrase FROM counts c JOIN counts d
    ON c.lang = d.lang AND d.size > c.size AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.f >= 80 * c.f
), cuts AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k
  FROM counts WHERE size >= 2 AND (lang, phrase) NOT IN (SELECT (lang, phrase) FROM covered)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1 :], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM best JOIN sizes USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER w <= 2000
"""

ORACLES = {
    "op3_substring_dedup": SUBSTRINGS,
    "op5_line_dedup": LINES,
    "op6_chat_format": CHATS,
    "op7_jaccard_join": COMPONENTS,
    "op11_url_rules": URLS,
    "op13_phrases": PHRASES,
}
