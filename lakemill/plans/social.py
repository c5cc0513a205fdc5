"""Articles → model results → posts, entities, topics and their bridges; comment sentiment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.names import normalize_maj, normalize_org
from lakemill.functions.scalar import int_or
from lakemill.operators import clean, heads, joins, scoring, social
from lakemill.operators.aggregates import counts_by_label
from lakemill.operators.aliases import MAJ_RULES, ORG_RULES, match_names, org_label
from lakemill.operators.bounds import checked_broadcast
from lakemill.operators.keys import grow_dictionary

COUNTS = ["likeCount", "commentCount", "shareCount"]


def model_results(articles: DataFrame, done: DataFrame | None, factory: Callable | heads.PostHeads, run_ts: str) -> DataFrame:
    """Scored rows for the articles not scored yet, by fitted heads or by a plug-in scorer.

    Rows without an id cannot be told apart from scored ones and are refused
    (``quality.refused`` counts them).
    """
    known = clean.require(articles, ["articleID"])
    new = known if done is None else joins.new_rows(known, done, "articleID", "postID")
    posts = new.select(
        F.col("articleID").alias("postID"), "timePublish", *[int_or(c).alias(c) for c in COUNTS], "type", "description"
    )
    if isinstance(factory, heads.PostHeads):
        scored = heads.score_posts(posts, "postID", "description", factory)
    else:
        scored = scoring.score_posts(posts, "description", factory)
    return clean.with_audit(scored.drop("description"), run_ts)


def new_results(results: DataFrame, posts: DataFrame | None) -> DataFrame:
    """Results whose post is not loaded yet; if there are none the load adds nothing. Results without an id are refused."""
    known = clean.require(results, ["postID"])
    return known if posts is None else joins.new_rows(known, posts, "postID")


def grow_entities(results: DataFrame, known: DataFrame | None, run_ts: str) -> DataFrame:
    """Entity types met for the first time, numbered after the known ones."""
    members = social.entity_members(results, "Label_NER")
    return clean.with_audit(social.describe_entities(grow_dictionary(known, members, "entityType", "entityID")), run_ts)


def grow_topics(results: DataFrame, known: DataFrame | None, run_ts: str) -> DataFrame:
    members = social.topic_members(results, "Label_Topic")
    return clean.with_audit(social.describe_topics(grow_dictionary(known, members, "topicName", "topicID")), run_ts)


def posts(results: DataFrame, run_ts: str) -> DataFrame:
    rows = results.select(
        "postID", F.col("description_Normalized").alias("description"), "timePublish", *COUNTS,
        F.col("Label_Intent").alias("intent"), "type",
    )
    return clean.with_audit(rows, run_ts)


def post_entity(results: DataFrame, entities: DataFrame, run_ts: str) -> DataFrame:
    rows = social.bridge_entity(results, entities, "postID", "Label_NER", "description_Normalized")
    return clean.with_audit(rows, run_ts)


def post_topic(results: DataFrame, topics: DataFrame, run_ts: str) -> DataFrame:
    return clean.with_audit(social.bridge_topic(results, topics, "postID", "Label_Topic"), run_ts)


def _same(c):
    return c


KINDS = {"ORG": (normalize_org, ORG_RULES, org_label), "MAJ": (normalize_maj, MAJ_RULES, _same)}


def normalise_names(bridge: DataFrame, entities: DataFrame, aliases: DataFrame, kind: str, run_ts: str) -> DataFrame:
    """The bridge with the normalised names of one entity type filled in.

    The type's rows all get a new value, NULL where no group matches, and a new stamp;
    other rows stay. Each distinct name is normalised and matched once.
    """
    normal, rules, label = KINDS[kind]
    wanted = checked_broadcast(entities.filter(F.col("entityType") == kind).select("entityID").distinct())
    inside = bridge.join(wanted, "entityID", "left_semi")
    names = inside.select("entityName").distinct().withColumn("clean", normal("entityName"))
    groups = match_names(names, "clean", aliases, rules).select("clean", label(F.col("grp")).alias("grp"))
    by_name = names.join(groups, "clean").select("entityName", "grp")
    filled = joins.skew_lookup(inside, by_name, "entityName", ["grp"]).withColumns(
        {"entityNameNormalized": F.col("grp"), "updated_at": F.lit(run_ts).cast("timestamp")}
    )
    outside = bridge.join(wanted, "entityID", "left_anti")
    return outside.unionByName(filled.select(*bridge.columns))


def sentiment_report(scored: DataFrame) -> DataFrame:
    """Comments of each sentiment per post and day."""
    return counts_by_label(scored, ["postID", F.to_date("commentTime").alias("day")], "sentiment", ["POS", "NEG", "NEU"])


def comment_sentiment(comments: DataFrame, done: DataFrame | None, factory: Callable | PipelineModel, run_ts: str, size: int | None = None) -> DataFrame:
    """Sentiment of the comments not scored yet, all of them or the next ``size`` in id order.

    Labels come from a head fitted on a column ``comment``, or from a plug-in scorer.
    Comments without an id are refused.
    """
    new = clean.require(clean.non_blank(comments, ["comment"]), ["commentID"])
    if done is not None:
        new = joins.new_rows(new, done, "commentID")
    if size is not None:
        new = new.orderBy("commentID").limit(size)
    rows = new.select(
        F.col("articleID").alias("postID"), "commentID", "comment", "commentTime",
        *[int_or(c).alias(c) for c in ("commentLike", "levelComment", "numberOfReply")], "created_at",
    )
    score = heads.score_sentiment if isinstance(factory, PipelineModel) else scoring.score_sentiment
    return score(rows, "comment", factory).withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
