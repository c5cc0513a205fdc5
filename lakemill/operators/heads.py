"""The post model as three Spark ML heads: fit on a labelled corpus, evaluate, apply to posts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.minitext import split_labels, split_trim
from lakemill.functions.scalar import squeeze, strip_space, words
from lakemill.operators import evaluation, training
from lakemill.operators.scoring import POST_DEFAULTS, SENTIMENT_DEFAULT


@dataclass(frozen=True)
class PostHeads:
    """Fitted heads: entity tags per word, topics per post, intent per post."""

    tags: training.TagHead
    topics: tuple
    topic_names: tuple[str, ...]
    intent: PipelineModel


def fit_heads(
    corpus: DataFrame, key: str, text: str, tags: str, topics: str, intent: str, topic_names: list[str], features: int = 1 << 14, iterations: int = 20
) -> PostHeads:
    """Fit on rows with a tag string, an ``A|B`` topic string and an intent. Misaligned tags are left out."""
    listed = corpus.select(key, F.col(text).alias("text"), words(text).alias("tokens"), words(tags).alias("tags"), split_labels(topics).alias("topics"), F.col(intent).alias("intent"))
    matching = listed.filter(F.size("tokens") == F.size("tags"))
    return PostHeads(
        training.fit_tags(matching, key, "tokens", "tags", features, iterations),
        training.fit_multi_label(listed, "text", "topics", topic_names, features, iterations),
        tuple(topic_names),
        training.fit_single_label(listed.filter(F.col("intent").isNotNull()), "text", "intent", features, iterations),
    )


def score_posts(df: DataFrame, key: str, text: str, heads: PostHeads) -> DataFrame:
    """``df`` with the normalised text, tags, topics and intent; blank posts get the defaults. ``key`` identifies a row."""
    plain = df.withColumn("__normal", F.coalesce(squeeze(strip_space(text)), F.lit("")))
    full = plain.filter("__normal <> ''").select(F.col(key).alias("__key"), F.col("__normal").alias("__text"))
    tagged = training.predict_tags(heads.tags, full.select("__key", words("__text").alias("__tokens")), "__key", "__tokens", "__tags")
    names = list(heads.topic_names)
    labelled = training.predict_multi_label(heads.topics, full.withColumnRenamed("__text", "text"), names, name="__topics")
    judged = training.predict_single_label(heads.intent, labelled, "__intent").select("__key", "__topics", "__intent")
    found = judged.join(tagged, "__key", "left")
    joined = plain.join(found, F.col(key) == F.col("__key"), "left")
    topics = F.array_join("__topics", "|")
    return joined.select(
        *df.columns,
        F.col("__normal").alias("description_Normalized"),
        F.coalesce("__tags", F.lit(POST_DEFAULTS["Label_NER"])).alias("Label_NER"),
        F.when(topics != "", topics).otherwise(POST_DEFAULTS["Label_Topic"]).alias("Label_Topic"),
        F.coalesce("__intent", F.lit(POST_DEFAULTS["Label_Intent"])).alias("Label_Intent"),
    )


def score_sentiment(df: DataFrame, text: str, model: PipelineModel, name: str = "sentiment") -> DataFrame:
    """``df`` with the label of a single-label head that was fitted on a column named ``text``; blank texts are NEU."""
    found = training.predict_single_label(model, df.withColumn(text, F.coalesce(text, F.lit(""))), "__label")
    blank = strip_space(text) == ""
    return found.withColumn(name, F.when(blank, F.lit(SENTIMENT_DEFAULT)).otherwise(F.col("__label"))).drop("__label")


def evaluate_heads(scored: DataFrame, tags: str, topics: str, intent: str) -> DataFrame:
    """F1 of each head, and their mean, of scored rows that also hold the true labels."""
    ner = evaluation.evaluate_ner(scored, tags, "Label_NER")
    sets = scored.select(split_labels(topics).alias("t"), F.filter(split_trim("Label_Topic", r"\|"), lambda x: x != "None").alias("p"))
    multi = evaluation.evaluate_multilabel(sets, "t", "p")
    single = evaluation.evaluate_weighted(scored, intent, "Label_Intent")
    heads = [("ner", ner), ("topic", multi), ("intent", single)]
    rows = None
    for name, df in heads:
        one = df.select(F.lit(name).alias("head"), "f1")
        rows = one if rows is None else rows.unionByName(one)
    mean = evaluation.overall_f1(ner, multi, single).select(F.lit("overall").alias("head"), F.col("overall_f1").alias("f1"))
    return rows.unionByName(mean)
