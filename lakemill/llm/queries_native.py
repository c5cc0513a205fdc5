"""Queries of the mixing, line, fingerprint and chat operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import chat, lines, mixing, sketches
from lakemill.llm.registry import query, table

#: A user and an assistant who both write the template's own marks.
TRICKY = r"\### Assistant: </turn> ok"

OP3_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST(floor(CAST(('0x' || substr(md5('20:band:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 10)) AS BIGINT)
      / 1099511627776.0 * 1024) AS INTEGER) AS band,
    CAST(('0x' || substr(md5('20:draw:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 10)) AS BIGINT) / CAST(1099511627776 AS DOUBLE) AS draw
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS HUGEINT) AS s FROM docs GROUP BY source),
weighed AS (
  SELECT source, s, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sizes),
-- Sources by size over weight: those clamped come first.
ranked AS (
  SELECT *, row_number() OVER by_ratio AS k,
    sum(s) OVER () - 3 * coalesce(sum(s) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ws
  FROM weighed WINDOW by_ratio AS (ORDER BY CAST(s AS DOUBLE) / w, encode(source) NULLS LAST)),
first_free AS (SELECT min(k) AS k FROM ranked WHERE NOT (3 * s * ws < w * rest)),
targets AS (
  SELECT r.source, r.s, CASE WHEN r.k < f.k THEN CAST(3 * r.s AS DOUBLE) ELSE CAST(r.w * g.rest AS DOUBLE) / CAST(g.ws AS DOUBLE) END AS target
  FROM ranked r, first_free f JOIN ranked g ON g.k = f.k),
parts AS (
  SELECT *, least(CAST(floor(CASE WHEN s > 0 THEN target / CAST(s AS DOUBLE) ELSE 0 END) AS BIGINT), 3) AS whole FROM targets),
plan AS (SELECT *, greatest(target - CAST(whole * s AS DOUBLE), 0) AS part FROM parts),
bands AS (SELECT source, band, CAST(sum(size) AS BIGINT) AS words FROM docs GROUP BY source, band),
placed AS (
  SELECT *, CAST(coalesce(sum(words) OVER (PARTITION BY source ORDER BY band ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM bands),
ends AS (
  SELECT p.source, p.s, p.target, p.whole, max(CASE WHEN b.before < p.part THEN b.band END) AS last_band,
    max(CASE WHEN b.words > 0 AND b.before < p.part AND b.before + b.words > p.part THEN (p.part - b.before) / CAST(b.words AS DOUBLE) END) AS share
  FROM plan p JOIN placed b ON b.source IS NOT DISTINCT FROM p.source GROUP BY ALL)
SELECT d.doc_id, d.size, CAST(e.s AS BIGINT) AS source_size, e.target,
  CAST(least(e.whole * d.size + CASE WHEN d.band < e.last_band THEN d.size WHEN d.band = e.last_band AND e.share IS NULL THEN d.size
    WHEN d.band = e.last_band THEN CAST(floor(d.size * e.share + d.draw) AS BIGINT) ELSE 0 END, 3 * d.size) AS BIGINT) AS taken
FROM docs d JOIN ends e ON e.source IS NOT DISTINCT FROM d.source
"""

OP5_SQL = r"""
WITH whole AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line FROM whole),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS home FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.home AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length('### ') + length(role) + (length(role) - length(regexp_replace(role, '[\\#<:]', '', 'g'))) + length(':') + 1
    + length(text) + (length(text) - length(regexp_replace(text, '[\\#<]', '', 'g'))) + length('</turn>') + 2 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM turns),
placed AS (SELECT *, CAST(sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS BIGINT) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, count(*) FILTER (WHERE role = 'assistant') AS n_examples,
  CAST(coalesce(sum(upto) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS example_chars
FROM placed GROUP BY conv_id
"""


@query("op3_source_mix", OP3_SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op5_line_dedup", OP5_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edit_likeness(table(spark, sf_dir, "documents"))


@query("op9_chat_examples", OP9_SQL)
def chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], turns.schema)
    return chat.read_back(chat.format_turns(turns.unionByName(tricky)))
