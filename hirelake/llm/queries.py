"""Queries over the test tables that apply the operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import automaton, bpe, counts, embeddings, language, minhash, packing, phrases, quality, rules, token_files, urls, variants
from hirelake.llm.arrow import importable
from hirelake.session import scratch_path, stage


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip_digests(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def _fold(folds: int) -> Column:
    """The fold of a document, by its id alone."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality.fit(docs, _table(spark, folder, "labels").where(_fold(5) != 0))
    scored = quality.score(docs, model, doc_id=F.col("doc_id"), held_out=_fold(5) == 0)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_rules(spark: SparkSession, folder: str) -> DataFrame:
    measured = stage(rules.measure(_table(spark, folder, "documents"), host="source", doc_id=F.col("doc_id")), "measures")
    return rules.judge(measured).select("doc_id", *rules.MEASURES, "base_failed", "kept")


def op5_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    profiles = language.fit(docs.where(_fold(4) != 2))
    return language.predict(docs, profiles, doc_id=F.col("doc_id"), held_out=_fold(4) == 2)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = counts.prefix_counts(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


#: The rules of the query, as they are to be.
URL_RULES = [
    urls.Rule(urls.ALLOW, "org/"),
    urls.Rule(urls.BLOCK, "example.org/es/"),
    urls.Rule(urls.BLOCK, "example.org/en/1"),
    urls.Rule(urls.ALLOW, "com/fr/"),
    urls.Rule(urls.BLOCK, "com/de/"),
]


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(_table(spark, folder, "pages"), URL_RULES)


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_files.write_token_files(
        _table(spark, folder, "documents"), scratch_path(spark, "token-files"),
        public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(manifest, digest=True)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, tokens=1024)


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.phrase_report(_table(spark, folder, "documents"))


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variant_groups(_table(spark, folder, "documents"))


def op13_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return automaton.round_trip_digests(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_rules": op3_rules,
    "op4_token_counts": op4_token_counts,
    "op5_embeddings": op5_embeddings,
    "op6_language": op6_language,
    "op7_minhash": op7_minhash,
    "op8_urls": op8_urls,
    "op9_token_files": op9_token_files,
    "op10_packing": op10_packing,
    "op11_phrases": op11_phrases,
    "op12_variants": op12_variants,
    "op13_automaton": op13_automaton,
}

#: The measures of whole texts, failed documents and shrunken host shares, with the limits of the operator.
RULES_SQL = r"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
spots AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
windows AS (
  SELECT doc_id, place, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' '
         || lead(word, 3) OVER w || ' ' || lead(word, 4) OVER w AS phrase
  FROM spots WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
repeats AS (
  SELECT doc_id, place, CASE WHEN phrase IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, phrase) >= 2 THEN 1 ELSE 0 END AS twice
  FROM windows),
covered AS (
  SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM repeats),
repeated AS (SELECT doc_id, sum(inside) AS n_repeat_words FROM covered GROUP BY doc_id),
measures AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts LEFT JOIN repeated USING (doc_id)),
failures AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 50 * n_words OR 100 * n_dup_lines > 30 * n_lines AS failed
  FROM measures),
hosts AS (SELECT source, count(*) AS n, sum(failed::INT) AS k FROM failures WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT sum(k) / sum(n) AS mean, sum(n * (k / n) * (k / n)) / sum(n) AS squares, count(*) / sum(n) AS per_document FROM hosts),
spreads AS (SELECT mean, squares - mean * mean - mean * (1 - mean) * per_document AS spread FROM moments),
prior AS (
  SELECT mean, CASE WHEN spread > 0 THEN greatest(1.0, mean * (1 - mean) / spread - 1) END AS strength FROM spreads),
rejected AS (
  SELECT source FROM hosts, prior
  WHERE coalesce((k + mean * strength) / (n + strength), mean) > greatest(0.25, 2 * mean))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM rejected)) AS kept
FROM failures
"""

#: All pairs of vectors, and what can be reached over links.
EMBEDDINGS_SQL = """
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(x, y) AS (SELECT vec_id, vec_id FROM vectors UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least ON vec_id = x
"""

#: Shingles as text, pairs that share one, and what can be reached over links.
MINHASH_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
spots AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
windows AS (
  SELECT doc_id, n, place, concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w) AS shingle
  FROM spots WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, shingle FROM windows WHERE place <= greatest(n - 3, 1)),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
found AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * n >= 80 * (p.size + q.size - n)),
links AS MATERIALIZED (SELECT x, y FROM found UNION ALL SELECT y, x FROM found),
reach(x, y) AS (SELECT doc_id, doc_id FROM texts UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT t.doc_id, coalesce(size, 0) AS n_shingles, component_id, t.doc_id = component_id AS kept
FROM texts t LEFT JOIN sizes s ON s.doc_id = t.doc_id JOIN least ON x = t.doc_id
"""

#: Phrases counted as text; a longer phrase that has all occurrences of one has one more word or is part of such a one.
PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed),
phrases AS (
  SELECT lang, w[i:i + m - 1] AS p FROM spots, (VALUES (1), (2), (3), (4), (5)) AS sizes(m) WHERE i + m - 1 <= len(w)),
counts AS MATERIALIZED (SELECT lang, p, count(*) AS a FROM phrases GROUP BY lang, p HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM listed GROUP BY lang),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM counts c JOIN totals USING (lang), (VALUES (1), (2), (3), (4)) AS places(k), counts x, counts y
  WHERE k < len(c.p) AND x.lang = c.lang AND y.lang = c.lang AND x.p = c.p[1:k] AND y.p = c.p[k + 1:]),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM cuts),
covered AS (
  SELECT lang, p[2:] AS p, a FROM counts WHERE len(p) > 2 UNION ALL SELECT lang, p[:-2], a FROM counts WHERE len(p) > 2),
dropped AS (SELECT DISTINCT c.lang, c.p FROM counts c JOIN covered v ON v.lang = c.lang AND v.p = c.p AND v.a >= c.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
         array_to_string(p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM lowest ANTI JOIN dropped USING (lang, p) WHERE place = 1)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op11_phrases": PHRASES_SQL, "op3_rules": RULES_SQL, "op5_embeddings": EMBEDDINGS_SQL, "op7_minhash": MINHASH_SQL}
