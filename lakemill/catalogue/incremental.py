"""Loads that run twice, model heads from training to scoring, and the reports of a load."""

from pyspark.sql import functions as F

from lakemill.catalogue.entities import rule_tags
from lakemill.catalogue.models import SPLIT_SQL, with_bar
from lakemill.catalogue.registry import ORACLES, query, table
from lakemill.functions.scalar import words
from lakemill.operators import evaluation, heads, scoring, social, training
from lakemill.plans import silver
from lakemill.plans import social as social_plan
from lakemill.session import cut

RUN_TS, LATER = "2025-01-01 00:00:00", "2025-02-01 00:00:00"


@query(
    "stable_ids",
    """WITH k AS (SELECT n_name AS name, row_number() OVER (ORDER BY n_name) AS id FROM nation WHERE n_regionkey >= 2)
       SELECT name, id FROM k UNION ALL
       SELECT n_name, (SELECT max(id) FROM k) + row_number() OVER (ORDER BY n_name) FROM nation WHERE n_regionkey < 2""",
)
def stable_ids(spark, sf):
    """A second load brings names that sort first; the known ones keep their ids."""
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("PhuongThuc"), "n_regionkey")
    first = cut(silver.selection_method(nations.filter("n_regionkey >= 2"), RUN_TS))
    second = silver.selection_method(nations, LATER, first)
    return second.select(F.col("selectionMethodName").alias("name"), F.col("selectionMethodId").cast("bigint").alias("id"))


@query("null_ids", """SELECT CAST(doc_id AS VARCHAR) AS "postID", 1 AS n FROM documents JOIN (SELECT DISTINCT doc_id FROM labels) USING (doc_id)""")
def null_ids(spark, sf):
    """Articles without a label have no id here: two runs of the scoring add neither them nor anything twice."""
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("known")).distinct()
    docs = table(spark, sf, "documents").join(known, F.col("doc_id") == F.col("known"), "left")
    articles = docs.select(
        F.col("known").cast("string").alias("articleID"), F.lit(RUN_TS).cast("timestamp").alias("timePublish"), F.lit("1").alias("likeCount"),
        F.lit("2").alias("commentCount"), F.lit("3").alias("shareCount"), F.lit("x").alias("type"), F.col("text").alias("description"),
    )
    scorer = scoring.shape_scorer({"the": "UNIVERSITY"})
    first = cut(social_plan.model_results(articles, None, scorer, RUN_TS))
    both = first.unionByName(social_plan.model_results(articles, first, scorer, LATER))
    fresh = social_plan.new_results(both, first.limit(0))
    return fresh.groupBy("postID").agg(F.count(F.lit(1)).alias("n"))


def _details(details, column):
    return " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in details.items()).join([f"CASE {column} ", ""])


@query(
    "describe_types",
    f"""WITH e AS (SELECT DISTINCT unnest([{", ".join(f"'{k}'" for k in social.ENTITY_DETAIL)}, p_type]) AS name FROM part),
          t AS (SELECT DISTINCT unnest([{", ".join(f"'{k}'" for k in social.TOPIC_DETAIL)}, p_brand]) AS name FROM part)
        SELECT 'entity' AS kind, name, {_details(social.ENTITY_DETAIL, "name")} ELSE 'Entity type: ' || name END AS detail FROM e
        UNION ALL SELECT 'topic', name, {_details(social.TOPIC_DETAIL, "name")} ELSE 'Chủ đề khác' END FROM t""",
)
def describe_types(spark, sf):
    """Every entity type and topic with a text of its own, and others that get the fallback."""
    parts = table(spark, sf, "part")

    def named(details, column, name):
        known = F.array(*[F.lit(k) for k in details], F.col(column))
        return parts.select(F.explode(known).alias(name)).distinct()

    entities = social.describe_entities(named(social.ENTITY_DETAIL, "p_type", "entityType"))
    topics = social.describe_topics(named(social.TOPIC_DETAIL, "p_brand", "topicName"))
    return entities.select(F.lit("entity").alias("kind"), F.col("entityType").alias("name"), F.col("entityDetail").alias("detail")).unionByName(
        topics.select(F.lit("topic").alias("kind"), F.col("topicName").alias("name"), F.col("topicDetail").alias("detail"))
    )


@query(
    "sentiment_per_day",
    """WITH w AS (SELECT conv_id, turn, string_split_regex(lower(text), '\\s+') AS ws FROM conversations),
         s AS (SELECT CAST(conv_id AS VARCHAR) AS "postID", DATE '2024-01-01' + CAST(turn // 2 AS INTEGER) AS day,
                sign(len(list_filter(ws, lambda x: x IN ('the', 'la'))) - len(list_filter(ws, lambda x: x IN ('of', 'die')))) AS s FROM w)
       SELECT "postID", day, count(*) FILTER (WHERE s = 1) AS "POS", count(*) FILTER (WHERE s = -1) AS "NEG",
              count(*) FILTER (WHERE s = 0) AS "NEU", count(*) AS total FROM s GROUP BY 1, 2""",
)
def sentiment_per_day(spark, sf):
    """Comments scored, then counted per post and day."""
    scored = social_plan.comment_sentiment(comments_of(spark, sf), None, scoring.lexicon_scorer(["the", "la"], ["of", "die"]), RUN_TS)
    return social_plan.sentiment_report(scored)


def comments_of(spark, sf):
    """Conversation turns as comments, two a day."""
    start = F.lit("2024-01-01").cast("date")
    return table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("articleID"), (F.col("conv_id") * 1000 + F.col("turn")).alias("commentID"), F.col("text").alias("comment"),
        F.date_add(start, F.floor(F.col("turn") / 2).cast("int")).cast("timestamp").alias("commentTime"), F.lit(0).alias("commentLike"),
        F.lit(1).alias("levelComment"), F.lit(0).alias("numberOfReply"), F.lit(RUN_TS).cast("timestamp").alias("created_at"),
    )


def corpus(spark, sf):
    """Conversation turns with tags by word shape, and topics and intent by the words they hold."""
    has = lambda w: F.array_contains(words("text"), w)
    rows = table(spark, sf, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("id"), "text", rule_tags("text").alias("tags"),
        F.concat_ws("|", F.when(has("the"), "UNIVERSITY"), F.when(has("de"), "LANGUAGE"), F.when(has("der"), "CAREER")).alias("topics"),
        F.when(has("the") | has("of"), "ask").otherwise("tell").alias("intent"),
    )
    return cut(evaluation.hash_split(rows, "id", {"train": 70, "test": 30}))


@query(
    "train_heads",
    f"""SELECT conv_id || '/' || turn AS id, {SPLIT_SQL.format("conv_id || '/' || turn")}, true AS scored, true AS good FROM conversations""",
)
def train_heads(spark, sf):
    """Fit the three heads, score every post with them, and hold the mean F1 on the held-out part against a bar."""
    rows = corpus(spark, sf)
    fitted = heads.fit_heads(
        rows.filter("split = 'train'"), "id", "text", "tags", "topics", "intent", ["UNIVERSITY", "LANGUAGE", "CAREER"], features=1 << 12, iterations=10
    )
    # Written once: the report reads it for each head, and the result once more.
    found = cut(heads.score_posts(rows, "id", "text", fitted))
    report = heads.evaluate_heads(found.filter("split = 'test'"), "tags", "topics", "intent")
    good = report.filter("head = 'overall'").select((F.col("f1") >= 0.6).alias("good"))
    scored = F.col("Label_NER").isNotNull() & F.col("Label_Topic").isNotNull() & F.col("Label_Intent").isNotNull()
    return with_bar(found.select("id", "split", scored.alias("scored")), good)


@query(
    "sentiment_head",
    """SELECT conv_id * 1000 + turn AS "commentID", CAST(conv_id AS VARCHAR) AS "postID", true AS known, true AS good FROM conversations""",
)
def sentiment_head(spark, sf):
    """Fit a sentiment head on a part of the comments, score all with it, and hold its accuracy on the other part against a bar."""
    has = lambda w: F.array_contains(words(F.lower("comment")), w)
    comments = comments_of(spark, sf).withColumn("truth", F.when(has("the"), "POS").when(has("de"), "NEG").otherwise("NEU"))
    parts = cut(evaluation.hash_split(comments, "commentID", {"train": 70, "test": 30}))
    model = training.fit_single_label(parts.filter("split = 'train'"), "comment", "truth", features=1 << 12, iterations=15)
    scored = social_plan.comment_sentiment(parts, None, model, RUN_TS)
    judged = scored.join(parts.filter("split = 'test'").select("commentID", "truth"), "commentID")
    good = judged.agg((F.avg((F.col("sentiment") == F.col("truth")).cast("int")) >= 0.5).alias("good"))
    known = F.col("sentiment").isin("POS", "NEG", "NEU")
    return with_bar(scored.select("commentID", "postID", known.alias("known")), good)


@query(
    "overall_f1",
    f"""SELECT round((a.f1 + b.f1 + c.f1) / 3, 6) AS overall_f1
        FROM ({ORACLES["eval_ner"]}) a, ({ORACLES["eval_multilabel"]}) b, ({ORACLES["eval_weighted"]}) c""",
)
def overall_f1(spark, sf):
    from lakemill.catalogue import models

    return evaluation.overall_f1(models.eval_ner(spark, sf), models.eval_multilabel(spark, sf), models.eval_weighted(spark, sf))
