"""Reports a load ends with."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.aggregates import count_and_distinct
from lakemill.operators.joins import count_children
from lakemill.operators.windows import first_in_group, top


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) in one query."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def loaded(tables: dict[str, DataFrame], least: int = 1) -> DataFrame:
    """Row counts with a verdict per table."""
    return row_counts(tables).withColumn("ok", F.col("n_rows") >= least)


def refused(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that lack one of the columns a load requires, per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot([], columns, "column", "n_refused")


def social_reports(entities: DataFrame, post_entity: DataFrame, topics: DataFrame, post_topic: DataFrame, posts: DataFrame) -> dict[str, DataFrame]:
    """The profile of a social load: mentions, topics, intents, names and samples."""
    return {
        "mentions_per_type": mention_distribution(entities, post_entity),
        "posts_per_topic": topic_distribution(topics, post_topic),
        "posts_per_intent": intent_distribution(posts),
        "most_mentioned": most_mentioned(entities, post_entity),
        "samples_per_type": samples_per_type(entities, post_entity),
    }


def mention_distribution(entities: DataFrame, bridge: DataFrame, n: int = 20) -> DataFrame:
    """Mentions per entity type, types without any included."""
    counted = count_children(entities, bridge, "entityID", ["entityType", "entityDetail"], "mention_count")
    return top(counted, ["-mention_count", "entityType"], n)


def topic_distribution(topics: DataFrame, bridge: DataFrame) -> DataFrame:
    return count_children(topics, bridge, "topicID", ["topicName", "topicDetail"], "post_count").orderBy(
        F.desc("post_count"), "topicName"
    )


def intent_distribution(posts: DataFrame) -> DataFrame:
    return posts.groupBy("intent").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "intent")


def most_mentioned(entities: DataFrame, bridge: DataFrame, n: int = 20) -> DataFrame:
    """Names by the number of posts that mention them."""
    once = bridge.select("postID", "entityID", "entityName").distinct()
    counted = once.groupBy("entityID", "entityName").agg(F.count("postID").alias("mention_count"))
    named = counted.join(entities.select("entityID", "entityType"), "entityID")
    summed = named.groupBy("entityType", "entityName").agg(F.sum("mention_count").alias("mention_count"))
    return top(summed, ["-mention_count", "entityType", "entityName"], n)


def samples_per_type(entities: DataFrame, bridge: DataFrame, n: int = 5) -> DataFrame:
    """The first n names of each type, in order."""
    # Types are few, so joining all names to them would bring those of a type to one task: each id is cut to n names first.
    names = bridge.filter(F.col("entityName").isNotNull()).select("entityID", "entityName")
    few = first_in_group(names, ["entityID"], ["entityName"], n).drop("rn")
    named = entities.join(few, "entityID").select("entityType", "entityDetail", "entityName")
    return first_in_group(named, ["entityType"], ["entityName"], n).withColumnRenamed("entityName", "sample_value")


def normalised_groups(bridge: DataFrame, entities: DataFrame, kind: str) -> DataFrame:
    """Records and distinct original names per normalised name, the NULL group included."""
    one_type = bridge.join(entities.filter(F.col("entityType") == kind).select("entityID"), "entityID")
    return count_and_distinct(
        one_type, ["entityNameNormalized"], "entityName", "total_records", "distinct_original_names"
    ).orderBy(F.desc("total_records"), "entityNameNormalized")
