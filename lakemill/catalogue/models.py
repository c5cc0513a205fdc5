"""Scoring, splits, evaluation, training."""

from pyspark.sql import functions as F

from lakemill.catalogue.entities import TOKENS, rule_tags, span_sql, tag_sql
from lakemill.catalogue.registry import query, table, wide_table
from lakemill.functions.scalar import words
from lakemill.operators import evaluation, scoring, training
from lakemill.session import cut, spread

GOOD, BAD = ["the", "la", "der"], ["of", "de", "die"]


def _count(words):
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(ws, lambda x: x IN ({listed})))"


@query(
    "score_sentiment",
    f"""WITH t AS (SELECT conv_id, turn, string_split_regex(lower(text), '\\s+') AS ws FROM conversations)
        SELECT conv_id, turn, CASE sign({_count(GOOD)} - {_count(BAD)}) WHEN 1 THEN 'POS' WHEN -1 THEN 'NEG' ELSE 'NEU' END AS sentiment
        FROM t""",
)
def score_sentiment(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return scoring.score_sentiment(rows, "text", scoring.lexicon_scorer(GOOD, BAD)).drop("text")


TOPIC_WORDS = {"the": "UNIVERSITY", "les": "LANGUAGE", "und": "CAREER", "Of": "STUDY"}


@query(
    "score_multitask",
    f"""WITH w0 AS (SELECT doc_id, text, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws FROM documents),
          c AS (SELECT *, [regexp_matches(x, '^[A-Z]') FOR x IN ws] AS cap FROM w0)
        SELECT doc_id, array_to_string(ws, ' ') AS "description_Normalized",
               array_to_string([CASE WHEN NOT x THEN 'O' WHEN i > 1 AND cap[i - 1] THEN 'I-ORG' ELSE 'B-ORG' END FOR x, i IN cap], ' ') AS "Label_NER",
               coalesce(nullif(concat_ws('|', CASE WHEN list_contains(ws, 'the') THEN 'UNIVERSITY' END,
                 CASE WHEN list_contains(ws, 'les') THEN 'LANGUAGE' END, CASE WHEN list_contains(ws, 'und') THEN 'CAREER' END,
                 CASE WHEN list_contains(ws, 'Of') THEN 'STUDY' END), ''), 'None') AS "Label_Topic",
               CASE WHEN contains(text, '?') THEN 'ask' ELSE 'tell' END AS "Label_Intent" FROM c""",
)
def score_multitask(spark, sf):
    docs = wide_table(spark, sf, "documents").select("doc_id", "text")
    return scoring.score_posts(docs, "text", scoring.shape_scorer(TOPIC_WORDS)).drop("text")


@query(
    "hash_split",
    """WITH h AS (SELECT doc_id, CAST('0x' || substr(md5('42:' || doc_id), 1, 8) AS BIGINT) % 100 AS b FROM documents)
       SELECT doc_id, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END AS split FROM h""",
)
def hash_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return evaluation.hash_split(docs, "doc_id", {"train": 70, "validation": 15, "test": 15})


@query(
    "eval_ner",
    f"""WITH {TOKENS}, gt AS (SELECT *, {tag_sql(5)} AS tag FROM w), gp AS (SELECT *, {tag_sql(10)} AS tag FROM w),
          {span_sql("gt", "st", True)}, {span_sql("gp", "pt", True)},
          k AS (SELECT (SELECT count(*) FROM st) AS nt, (SELECT count(*) FROM pt) AS np,
                (SELECT count(*) FROM st JOIN pt ON st.doc_id = pt.doc_id AND st.first = pt.first AND st.last = pt.last
                 AND substr(st.tag, 3) = substr(pt.tag, 3)) AS hit,
                (SELECT avg(CAST(gt.tag = gp.tag AS INTEGER)) FROM gt JOIN gp USING (doc_id, i)) AS acc)
        SELECT round(hit / np, 6) AS precision, round(hit / nt, 6) AS recall, round(2 * (hit / np) * (hit / nt) / (hit / np + hit / nt), 6) AS f1,
               round(acc, 6) AS accuracy FROM k""",
)
def eval_ner(spark, sf):
    docs = wide_table(spark, sf, "documents").select(rule_tags("text", 5).alias("truth"), rule_tags("text", 10).alias("predicted"))
    return evaluation.evaluate_ner(docs, "truth", "predicted")


@query(
    "eval_multilabel",
    """WITH s AS (SELECT list_filter([lang, CASE quality WHEN 1 THEN 'good' END, CASE toxic WHEN 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS t,
              list_filter([CASE WHEN source <> 'src1' THEN lang END, CASE WHEN n_chars > 800 THEN 'good' END, CASE WHEN n_chars < 600 THEN 'toxic' END],
                lambda x: x IS NOT NULL) AS p FROM documents JOIN labels USING (doc_id)),
         k AS (SELECT len(list_intersect(t, p)) AS hit, len(t) AS nt, len(p) AS np FROM s)
       SELECT round(avg(CASE WHEN np = 0 THEN 0 ELSE hit / np END), 6) AS precision,
              round(avg(CASE WHEN nt = 0 THEN 0 ELSE hit / nt END), 6) AS recall,
              round(avg(CASE WHEN np + nt = 0 THEN 0 ELSE 2 * hit / (np + nt) END), 6) AS f1,
              round(avg(CASE WHEN hit = nt AND hit = np THEN 1 ELSE 0 END), 6) AS accuracy FROM k""",
)
def eval_multilabel(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    truth = F.array_compact(F.array("lang", F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic")))
    predicted = F.array_compact(
        F.array(
            F.when(F.col("source") != "src1", F.col("lang")), F.when(F.col("n_chars") > 800, "good"), F.when(F.col("n_chars") < 600, "toxic")
        )
    )
    return evaluation.evaluate_multilabel(rows.select(truth.alias("truth"), predicted.alias("predicted")), "truth", "predicted")


@query(
    "eval_weighted",
    """WITH s AS (SELECT CASE WHEN quality = 1 THEN lang ELSE 'low' END AS t, CASE WHEN n_chars > 800 THEN lang ELSE 'low' END AS p
                  FROM documents JOIN labels USING (doc_id)),
         c AS (SELECT label, count(*) FILTER (WHERE side = 't') AS nt, count(*) FILTER (WHERE side = 'p') AS np,
                      count(*) FILTER (WHERE side = 't' AND same) AS hit
               FROM (SELECT t AS label, 't' AS side, t = p AS same FROM s UNION ALL SELECT p, 'p', t = p FROM s) GROUP BY label),
         r AS (SELECT nt, hit, CASE WHEN np = 0 THEN 0 ELSE hit / np END AS p, CASE WHEN nt = 0 THEN 0 ELSE hit / nt END AS r FROM c)
       SELECT round(sum(p * nt) / sum(nt), 6) AS precision, round(sum(r * nt) / sum(nt), 6) AS recall,
              round(sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * nt) / sum(nt), 6) AS f1,
              round(sum(hit) / sum(nt), 6) AS accuracy FROM r""",
)
def eval_weighted(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.when(F.col("quality") == 1, F.col("lang")).otherwise("low").alias("truth"),
        F.when(F.col("n_chars") > 800, F.col("lang")).otherwise("low").alias("predicted"),
    )
    return evaluation.evaluate_weighted(rows, "truth", "predicted")


SPLIT_SQL = "CASE WHEN CAST('0x' || substr(md5('42:' || {}), 1, 8) AS BIGINT) % 100 < 70 THEN 'train' ELSE 'test' END AS split"


def with_bar(df, good, name="good"):
    """Every row with the verdict of a one-row report."""
    return df.withColumn(name, good.scalar())


@query("train_text_clf", f"SELECT doc_id, {SPLIT_SQL.format('doc_id')}, true AS known, true AS good FROM documents")
def train_text_clf(spark, sf):
    """Learn the language of a text on the training part, predict it for all texts, and hold
    the accuracy on the other part against a bar."""
    docs = evaluation.hash_split(wide_table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id", {"train": 70, "test": 30})
    model = training.fit_single_label(docs.filter("split = 'train'"), "text", "lang", features=1 << 12, iterations=10)
    found = training.predict_single_label(model, docs, "predicted")
    right = found.filter("split = 'test'").agg((F.avg((F.col("predicted") == F.col("lang")).cast("int")) >= 0.85).alias("good"))
    known = F.col("predicted").isNotNull()
    return with_bar(found.select("doc_id", "split", known.alias("known")), right)


@query("train_multi_label", f"SELECT doc_id, {SPLIT_SQL.format('doc_id')}, true AS good FROM documents JOIN labels USING (doc_id)")
def train_multi_label(spark, sf):
    """Learn two independent labels per text on the training part, predict the sets, and hold
    the F1 on the other part against a bar."""
    rows = wide_table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text",
        F.array_compact(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic"))).alias("labels"),
    )
    names = ["good", "toxic"]
    parts = evaluation.hash_split(rows, "doc_id", {"train": 70, "test": 30})
    model = training.fit_multi_label(parts.filter("split = 'train'"), "text", "labels", names, features=1 << 12, iterations=10)
    found = training.predict_multi_label(model, parts, names)
    quality = evaluation.evaluate_multilabel(found.filter("split = 'test'"), "labels", "predicted")
    return with_bar(found.select("doc_id", "split"), quality.select((F.col("f1") >= 0.7).alias("good")))


@query("train_tags", f"SELECT conv_id || '/' || turn AS id, {SPLIT_SQL.format("conv_id || '/' || turn")}, true AS aligned, true AS good FROM conversations")
def train_tags(spark, sf):
    """Learn rule tags on a part of the conversations, one example per token, tag them all,
    and hold the F1 on the other part against a bar."""
    rows = spread(table(spark, sf, "conversations")).select(
        F.concat_ws("/", "conv_id", "turn").alias("id"), words("text").alias("tokens"), words(rule_tags("text")).alias("tags")
    )
    parts = cut(evaluation.hash_split(rows, "id", {"train": 70, "test": 30}))
    model = training.fit_tags(parts.filter("split = 'train'"), "id", "tokens", "tags", features=1 << 12, iterations=10)
    # Written once: the verdict and the result read it.
    tagged = cut(parts.join(training.predict_tags(model, parts, "id", "tokens"), "id", "left"))
    truth = tagged.filter("split = 'test'").select(F.array_join("tags", " ").alias("truth"), "predicted")
    quality = evaluation.evaluate_ner(truth, "truth", "predicted")
    aligned = F.size(words(F.coalesce("predicted", F.lit("")))) == F.size("tokens")
    return with_bar(tagged.select("id", "split", aligned.alias("aligned")), quality.select((F.col("f1") >= 0.6).alias("good")))
