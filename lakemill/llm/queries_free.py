"""Queries of the language, contamination, repeat, secret, near-copy, toxicity, alignment, collocation and fingerprint-distance operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import alignment, collocations, contamination, jaccard, language, repeats, secrets, simhash, toxicity
from lakemill.llm.registry import query, table

OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, n, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT item, ws, least(13, len(ws)) AS n, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM docs, sizes WHERE len(ws) >= n)),
found AS (SELECT p.doc_id, p.n, p.i, w.item FROM places p JOIN windows w ON p.n = w.n AND p.win = w.win),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
  sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.ws) AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

OP8_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS i FROM docs WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs p JOIN sizes a ON a.doc_id = p.x JOIN sizes b ON b.doc_id = p.y WHERE 100 * p.both >= 90 * (a.n + b.n - p.both)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.least AS component_id
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT x, min(y) AS least FROM reach GROUP BY x) r ON r.x = d.doc_id
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM documents),
totals AS (SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
found AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM grams WHERE k >= 2),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(ws[1 : j], ' ') AS x, array_to_string(ws[j + 1 : k], ' ') AS y
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM found)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, p.f AS l, q.f AS r, t.n, (1000 * c.a * t.n) // (p.f * q.f) AS score
  FROM cuts c JOIN grams p ON p.lang = c.lang AND p.phrase = c.x JOIN grams q ON q.lang = c.lang AND q.phrase = c.y JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_of AS (
  SELECT lang, f, k, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, i
  FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS i FROM (SELECT *, unnest(generate_series(2, k - 1)) AS m FROM found WHERE k > 2))),
around AS (
  SELECT lang, phrase, max(f) AS most, count(*) FILTER (WHERE m = k - 1 AND i = 2) AS n_left, count(*) FILTER (WHERE m = k - 1 AND i = 1) AS n_right
  FROM inner_of GROUP BY lang, phrase),
kept AS (
  SELECT s.*, coalesce(o.n_left, 0) AS n_left, coalesce(o.n_right, 0) AS n_right FROM least s LEFT JOIN around o USING (lang, phrase)
  WHERE o.most IS NULL OR 100 * o.most < 100 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score,
  n_left, n_right FROM ranked WHERE rank <= 2000
"""


def held_out(id_col: str) -> Column:
    """The fold that no label is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, ~held_out("doc_id"))
    return language.identify(docs, model, carry=["doc_id"]).withColumn("held_out", held_out("doc_id"))


@query("op2_decontamination", OP2_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination.mark_contamination(docs, benchmark, carry=["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op4_repeat_removal")
def repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op6_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.array(*[F.lit(r.kind) for r in secrets.BASE_RULES])
    count = lambda kind: F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES],
        F.sha2(secrets.joined(F.filter("found", lambda f: F.array_contains(base, f["kind"]))), 256).alias("base_sha256"),
        secrets.joined(F.col("found")).alias("spans"),
    )


@query("op8_ngram_jaccard_join", OP8_SQL)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_near_copies(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic", ~held_out("lid"))
    return toxicity.score(docs, model, carry=["doc_id"]).withColumn("held_out", held_out("doc_id"))


@query("op11_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit("")).alias("groups_sha256")
    slim = aligned.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", digest, "link_pairs", "link_counts")
    return alignment.score_links(slim)


@query("op12_phrase_collocations", OP12_SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link_by_simhash(table(spark, sf_dir, "documents"))
