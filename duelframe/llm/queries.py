"""Registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontaminate, dual_tree, language, line_dedup, near_dedup, packing, repetition, resampling, sharding,
               suffix_dedup, tool_calls, toxicity)
from .storage import documents


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(repetition.measure(documents(spark, sf_dir))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.train(docs.where(~_held_out()))
    return language.predict(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score", "n_spans")


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as calls of one tool, each based on the user turn before it; the turn after a call is its result."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    key = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    asked = turns.where("role = 'user'")
    calls = asked.select("conv_id", key(F.col("turn")).alias("call_id"), F.when(F.col("turn") >= 2, key(F.col("turn") - 2)).alias("parent_id"),
                         F.lit("reply").alias("name"), F.to_json(F.struct(F.col("text").alias("query"), "turn")).alias("arguments"), "turn")
    results = turns.where("role = 'assistant'").select("conv_id", key(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"), "turn")
    return tool_calls.link_calls(spark, calls, results, REPLY)


REPLY = {"reply": {"type": "object", "required": ["query", "turn"], "additionalProperties": False, "properties": {
    "query": {"type": "string", "minLength": 20}, "turn": {"type": "integer", "minimum": 0}}}}


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, documents(spark, sf_dir)).drop("kept_text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_added(documents(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled good texts are the target; as large a share of all texts is selected as is good among the labelled."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality is not null")
    share = labels.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return resampling.resample(spark, documents(spark, sf_dir), labels.where("quality = 1"), 1.0 if share is None else share)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~_held_out()).select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", _held_out().alias("held_out"), "score", "predicted", "n_hits")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(spark, documents(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.rank(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(spark, documents(spark, sf_dir), with_text=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_quality_rules, op3_language_id, op4_tool_calls, op5_suffix_array_dedup, op6_packing,
    op7_sharding, op8_quality_classifier, op9_benchmark_decontamination, op10_toxicity, op11_tokenizer_alignment, op12_ranked_search,
    op13_line_dedup)}

_LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

CHECKS: dict[str, str] = {
    "op1_minhash_near_dedup": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * c >= 75 * (len(x.s) + len(y.s) - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN ways l ON l.a = r.b)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = s.doc_id""",
    "op2_quality_rules": f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS g
      FROM w CROSS JOIN (SELECT unnest([3, {repetition.LEAST_REPEAT}, {repetition.MAX_REPEAT + 1}]) AS k)),
again AS (SELECT doc_id, k, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, k, g) > 1),
inside AS (SELECT doc_id, k, count(DISTINCT p) AS n FROM (SELECT doc_id, k, unnest(range(i, i + k)) AS p FROM again) GROUP BY ALL),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines,
    coalesce(a.n, 0)::BIGINT AS n_repeat_words, coalesce(b.n, 0)::BIGINT AS n_covered_words, c.n IS NOT NULL AS long_repeat
  FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN inside a ON a.doc_id = w.doc_id AND a.k = 3
  LEFT JOIN inside b ON b.doc_id = w.doc_id AND b.k = {repetition.LEAST_REPEAT} LEFT JOIN inside c ON c.doc_id = w.doc_id AND c.k = {repetition.MAX_REPEAT + 1})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_covered_words * 100 <= n_words * {repetition.MAX_COVERED} AND NOT long_repeat AS kept,
  n_covered_words FROM m""",
    "op4_tool_calls": """
WITH RECURSIVE calls AS (SELECT conv_id, turn, text, conv_id || ':' || turn AS call_id, CASE WHEN turn >= 2 THEN conv_id || ':' || (turn - 2) END AS parent
  FROM conversations WHERE role = 'user'),
depths AS (SELECT conv_id, turn, 0::BIGINT AS depth FROM calls WHERE parent IS NULL
  UNION ALL SELECT c.conv_id, c.turn, d.depth + 1 FROM depths d JOIN calls c ON c.conv_id = d.conv_id AND c.turn = d.turn + 2),
r AS (SELECT conv_id, turn - 1 AS turn, text AS content FROM conversations WHERE role = 'assistant'),
j AS (SELECT c.*, d.depth, r.content, CASE WHEN d.depth IS NULL THEN 'bad_parent' WHEN text IS NULL OR length(text) < 20 THEN 'invalid_arguments'
    WHEN r.turn IS NULL THEN 'missing_result' ELSE 'ok' END AS status
  FROM calls c LEFT JOIN depths d USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn))
SELECT conv_id, call_id, turn, depth, row_number() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn, call_id) - 1 AS position, status,
  '{"arguments":{"query":' || to_json(text) || ',"turn":' || turn || '},"id":"' || call_id || '","name":"reply"' ||
  CASE WHEN parent IS NULL THEN '' ELSE ',"parent":"' || parent || '"' END || CASE WHEN status = 'ok' THEN ',"result":' || to_json(content) ELSE '' END || '}' AS message
FROM j""",
    "op5_suffix_array_dedup": """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS i FROM h)),
hit AS (SELECT doc_id, i FROM w QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
edges AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS fresh FROM hit),
numbered AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM edges),
spans AS (SELECT doc_id, s, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY ALL),
pieces AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
gone AS (SELECT p.doc_id, count(*) AS n, sum(b - a) AS bytes, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM pieces p JOIN h USING (doc_id) GROUP BY p.doc_id)
SELECT h.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(bytes, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM h LEFT JOIN gone USING (doc_id)""",
    "op12_ranked_search": f"""
WITH d AS (SELECT doc_id, t, len(t)::BIGINT AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
o AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM o, s GROUP BY term),
p AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // l))) AS p FROM o JOIN w USING (term), s),
r AS (SELECT item_id, doc_id, sum(p)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY ALL HAVING sum(p) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10""",
    "op13_line_dedup": f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
l AS (SELECT doc_id, i, s[i] AS line, translate(trim(s[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOW}) AS key
  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM s)),
shared AS (SELECT key, max(doc_id) AS last_doc FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.*, coalesce(l.doc_id < s.last_doc, false) AS gone FROM l LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM marked GROUP BY doc_id""",
}
