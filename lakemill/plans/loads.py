"""Whole loads: read what is new, compute, write to the lake's tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import changes, quality
from lakemill.operators.aggregates import null_counts
from lakemill.operators.clean import dedup_by
from lakemill.plans import feeds, silver, social, star
from lakemill.session import cut
from lakemill.sinks.tables import Lake
from lakemill.sources.csv_files import read_csv
from lakemill.streaming.ledger import LOADED, load_new_files, read_ledger


@dataclass(frozen=True)
class Bronze:
    """Where the raw files lie. Folders of the last five are read file by file, once."""

    schools: list[str]
    majors: str
    subject_groups: str
    benchmarks: str
    regions: str
    major_groups: str | None = None
    student_scores: str | None = None
    tiktok_posts: str | None = None
    tiktok_comments: str | None = None
    facebook_posts: str | None = None
    facebook_comments: str | None = None


def load_reference_tables(spark: SparkSession, lake: Lake, bronze: Bronze, run_ts: str) -> None:
    """The small tables, replaced as a whole."""
    groups = read_csv(spark, bronze.subject_groups)
    scores = read_csv(spark, bronze.benchmarks)
    lake.replace("school", silver.school(read_csv(spark, bronze.schools), run_ts))
    lake.replace("major", silver.major(read_csv(spark, bronze.majors), run_ts))
    if bronze.major_groups:
        lake.replace("major_group", silver.major_group(read_csv(spark, bronze.major_groups), run_ts))
    lake.replace("subject_group", silver.subject_group(groups, run_ts))
    # Other tables hold these ids, so members keep theirs for good.
    lake.replace("subject", silver.subject(groups, run_ts, lake.read_or_none("subject")))
    lake.replace("selection_method", silver.selection_method(scores, run_ts, lake.read_or_none("selection_method")))
    lake.replace("grading_scale", silver.grading_scale(scores, run_ts, lake.read_or_none("grading_scale")))
    lake.replace("region", silver.region(read_csv(spark, bronze.regions), run_ts))


def load_benchmark(spark: SparkSession, lake: Lake, bronze: Bronze, run_ts: str) -> None:
    """First load creates the table, later ones update scores and insert new keys."""
    stamp = F.lit(run_ts).cast("timestamp")
    rows = silver.benchmark(
        read_csv(spark, bronze.benchmarks), lake.read("selection_method"), lake.read("subject_group"), lake.read("grading_scale")
    ).withColumns({"created_at": stamp, "updated_at": stamp})
    lake.upsert("benchmark", rows, silver.BENCHMARK_KEY, ["score", "updated_at"], inserts=silver.benchmark_id())


class Stage:
    """Rows of new files, staged once each, until they are in their table.

    A run that was staged but whose table write failed is handed out again by the next
    call. Only a stop between a table write and ``done`` can repeat an append.
    """

    def __init__(self, spark: SparkSession, lake: Lake, folder: str, name: str, key_column: str, run_ts: str):
        self.spark, self.run_ts = spark, run_ts
        self.root = os.path.join(lake.root, "_stage", name)
        self.merged = os.path.join(self.root, "merged")
        load_new_files(
            spark, folder, os.path.join(self.root, "rows"), os.path.join(self.root, "ledger"), lambda df: df, key_column, run_ts
        )
        staged, merged = self._runs(os.path.join(self.root, "ledger")), self._runs(self.merged)
        # Only the runs still to be merged come to the driver.
        self.runs = sorted(r["run"] for r in staged.join(merged, "run", "left_anti").collect())

    def _runs(self, ledger: str) -> DataFrame:
        return read_ledger(self.spark, ledger).filter(F.col("status") == LOADED).select("run").distinct()

    def rows(self, run: str | None = None) -> DataFrame | None:
        """Rows of one run, or of all that are left."""
        if not self.runs:
            return None
        paths = [os.path.join(self.root, "rows", f"ingest_run={r}") for r in ([run] if run else self.runs)]
        return self.spark.read.option("mergeSchema", True).parquet(*paths)

    def done(self, run: str | None = None) -> None:
        marks = self.spark.createDataFrame([(r, r, LOADED) for r in ([run] if run else self.runs)], "path string, run string, status string")
        marks.withColumn("at", F.lit(self.run_ts).cast("timestamp")).coalesce(1).write.mode("append").parquet(self.merged)


def load_student_scores(spark: SparkSession, lake: Lake, bronze: Bronze, run_ts: str) -> None:
    """New files only; students in them replace their earlier rows. What changes is noted for the counts that follow it."""
    stage = Stage(spark, lake, bronze.student_scores, "student_scores", "SBD", run_ts)
    stamp = F.lit(run_ts).cast("timestamp")
    # A student id ends in its year, so a student's rows are all in that partition.
    key, home = ["studentId"], ["year"]
    for run in stage.runs:
        rows = silver.student_scores(stage.rows(run), lake.read("subject"), "source_file").withColumns({"created_at": stamp, "updated_at": stamp})
        batch = feeds.put_changes(lake, "student_scores", run, lake.fit("student_scores", dedup_by(rows, key, key)), key, home)
        lake.replace_by_key("student_scores", batch, key, key, home=home)
        stage.done(run)


def load_articles(spark: SparkSession, lake: Lake, bronze: Bronze, run_ts: str) -> None:
    """TikTok posts are added; Facebook posts update the ones known by url."""
    if bronze.tiktok_posts:
        stage = Stage(spark, lake, bronze.tiktok_posts, "tiktok_posts", "ID", run_ts)
        if stage.runs:
            lake.append("article", silver.tiktok_posts(stage.rows(), run_ts))
            stage.done()
    if bronze.facebook_posts:
        stage = Stage(spark, lake, bronze.facebook_posts, "facebook_posts", "ID", run_ts)
        if stage.runs:
            posts = cut(lake.fit("article", silver.facebook_posts(stage.rows(), run_ts)))
            if lake.exists("article"):
                lake.rewrite("article", posts, ["url", "type"], silver.merge_facebook_posts)
            else:
                lake.replace("article", silver.merge_facebook_posts(posts.limit(0), posts))
            stage.done()


def load_comments(spark: SparkSession, lake: Lake, bronze: Bronze, run_ts: str) -> None:
    """Comments of new files, numbered on from the highest id."""
    sources = [
        (bronze.tiktok_comments, "tiktok_comments", "ID_Post", silver.tiktok_comments),
        (bronze.facebook_comments, "facebook_comments", "Id_post", silver.facebook_comments),
    ]
    for folder, name, key_column, make in sources:
        if not folder:
            continue
        stage = Stage(spark, lake, folder, name, key_column, run_ts)
        if stage.runs:
            known = lake.read_or_none("comment")
            lake.append("comment", silver.number_comments(make(stage.rows(), run_ts), known))
            stage.done()


def bronze_to_silver(spark: SparkSession, lake: Lake, bronze: Bronze, run_ts: str) -> DataFrame:
    """All silver tables; returns their row counts."""
    load_reference_tables(spark, lake, bronze, run_ts)
    load_benchmark(spark, lake, bronze, run_ts)
    if bronze.student_scores:
        load_student_scores(spark, lake, bronze, run_ts)
    load_articles(spark, lake, bronze, run_ts)
    load_comments(spark, lake, bronze, run_ts)
    return quality.loaded({t: lake.read(t) for t in lake.list_tables()})


def student_counts(silver_lake: Lake, gold: Lake) -> tuple[DataFrame, DataFrame]:
    """Students per subject and per group, bin by bin.

    Counts of earlier loads are kept, and only the changes since are counted: students that came
    in, and, taken off, those they replaced. Counts per group also depend on the groups; other
    groups begin counts of their own, from the first change on. A table that was loaded without a
    feed is counted whole.
    """
    log = feeds.feed(silver_lake, "student_scores")
    members = star.members_by_id(silver_lake.read("subject_group"), silver_lake.read("subject"))
    if not log.complete():
        scores = silver_lake.read("student_scores")
        return star.count_by_subject(scores), star.count_by_group(scores, members)
    listed = F.array_sort(F.collect_list(F.struct("subjectGroupId", "member")))
    version = members.agg(F.sha2(F.to_json(listed), 256).alias("v")).first()["v"]
    by_subject = feeds.follow(
        feeds.Runs(gold, "_counts", "by_subject"), log, lambda rows: star.count_by_subject(rows, feeds.SIGN), star.BY_SUBJECT
    )
    by_group = feeds.follow(
        feeds.Runs(gold, "_counts", f"by_group-{version}"), log, lambda rows: star.count_by_group(rows, members, feeds.SIGN), star.BY_GROUP
    )
    return by_subject, by_group


def silver_to_star(silver_lake: Lake, gold: Lake) -> DataFrame:
    """Dimensions, then the facts that use them."""
    read = silver_lake.read
    gold.replace("dim_time", star.dim_time(read("benchmark")))
    gold.replace("dim_region", star.dim_region(read("region")))
    gold.replace("dim_school", star.dim_school(read("school")))
    gold.replace("dim_major", star.dim_major(read("major")))
    gold.replace("dim_subject", star.dim_subject(read("subject")))
    gold.replace("dim_subject_group", star.dim_subject_group(read("subject_group")))
    gold.replace("dim_selection_method", star.dim_selection_method(read("selection_method")))
    gold.replace("dim_grading_scale", star.dim_grading_scale(read("grading_scale")))
    dims = {t: gold.read(t) for t in gold.list_tables() if t.startswith("dim_")}
    gold.replace("fact_benchmark", star.fact_benchmark(read("benchmark"), dims))
    if silver_lake.exists("student_scores"):
        by_subject, by_group = student_counts(silver_lake, gold)
        gold.replace("fact_score_distribution_by_subject", star.distribution_by_subject(by_subject, dims))
        gold.replace("fact_score_distribution_by_subject_group", star.distribution_by_group(by_group, dims))
    return quality.loaded({t: gold.read(t) for t in gold.list_tables()})


def score_articles(silver_lake: Lake, factory: Callable, run_ts: str) -> None:
    """Run the post model over the articles that have no result yet."""
    done = silver_lake.read_or_none("result_multi_model")
    silver_lake.append("result_multi_model", social.model_results(silver_lake.read("article"), done, factory, run_ts))


def load_social(silver_lake: Lake, gold: Lake, run_ts: str) -> DataFrame:
    """Entities, topics, posts and bridges of the results not loaded yet.

    The posts are written last: a load that stops halfway is found again by the next, and
    what it had already added to the bridges is not added twice.
    """
    fresh = cut(social.new_results(silver_lake.read("result_multi_model"), gold.read_or_none("Post")))
    gold.append("Entity", social.grow_entities(fresh, gold.read_or_none("Entity"), run_ts))
    gold.append("Topic", social.grow_topics(fresh, gold.read_or_none("Topic"), run_ts))
    bridges = {
        "Post_Entity": social.post_entity(fresh, gold.read("Entity"), run_ts),
        "Post_Topic": social.post_topic(fresh, gold.read("Topic"), run_ts),
    }
    for table, rows in bridges.items():
        known = gold.read_or_none(table)
        gold.append(table, rows if known is None else changes.insert_absent(known, rows, ["postID"]))
    gold.append("Post", social.posts(fresh, run_ts))
    return quality.loaded({t: gold.read(t) for t in gold.list_tables()}, least=0)


def social_reports(gold: Lake) -> dict[str, DataFrame]:
    """The profile to look at when a social load has ended."""
    return quality.social_reports(*[gold.read(t) for t in ("Entity", "Post_Entity", "Topic", "Post_Topic", "Post")])


def normalise_names(gold: Lake, aliases: DataFrame, kind: str, run_ts: str) -> DataFrame:
    """Fill the normalised names of one entity type and report records per name."""
    entities = gold.read("Entity")
    _of_kind(gold, kind, lambda bridge, _: social.normalise_names(bridge, entities, aliases, kind, run_ts))
    return quality.normalised_groups(gold.read("Post_Entity"), gold.read("Entity"), kind)


def reset_names(gold: Lake, run_ts: str, kind: str | None = None) -> DataFrame:
    """Clear the normalised names, of one type or of all, and count what is left."""
    stamp = F.lit(run_ts).cast("timestamp")
    if kind is None:
        gold.replace("Post_Entity", changes.reset_column(gold.read("Post_Entity"), "entityNameNormalized", stamp))
    else:
        _of_kind(gold, kind, lambda bridge, _: changes.reset_column(bridge, "entityNameNormalized", stamp))
    return name_status(gold)


def _of_kind(gold: Lake, kind: str, change: Callable) -> None:
    """Change the bridge rows of one entity type: the bridge is partitioned by entity, so others are not touched."""
    ids = gold.read("Entity").filter(F.col("entityType") == kind).select("entityID").distinct()
    gold.rewrite("Post_Entity", ids, ["entityID"], change)


def name_status(gold: Lake) -> DataFrame:
    """Normalised and open names per entity type."""
    joined = gold.read("Post_Entity").join(gold.read("Entity").select("entityID", "entityType"), "entityID")
    return null_counts(joined, ["entityType"], "entityNameNormalized").orderBy("entityType")


def score_comments(silver_lake: Lake, gold: Lake, factory: Callable, run_ts: str, size: int | None = None) -> None:
    """Sentiment of comments not scored yet."""
    done = gold.read_or_none("Comment_Sentiment")
    gold.append("Comment_Sentiment", social.comment_sentiment(silver_lake.read("comment"), done, factory, run_ts, size))
