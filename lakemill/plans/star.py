"""Silver tables → dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.minitext import split_trim
from lakemill.operators import aggregates as agg
from lakemill.operators import windows
from lakemill.operators.bounds import GROUP_ROWS, hot_groups
from lakemill.operators.joins import Dim, star_resolve
from lakemill.operators.keys import surrogate_key, year_dimension
from lakemill.session import discard, release, stored


def dimension(rows: DataFrame, key: str, natural: str, attributes: list[str]) -> DataFrame:
    """Key column, natural key and attributes, numbered in natural-key order."""
    order = [natural, *attributes]
    return surrogate_key(rows.select(*order), key, order).select(F.col(key).cast("int"), *order)


def dim_time(benchmark: DataFrame) -> DataFrame:
    return year_dimension(benchmark, "year")


def dim_region(rows: DataFrame) -> DataFrame:
    return dimension(rows, "regionKey", "regionId", ["regionName"])


def dim_school(rows: DataFrame) -> DataFrame:
    return dimension(rows, "schoolKey", "schoolId", ["schoolName", "province"])


def dim_major(rows: DataFrame) -> DataFrame:
    return dimension(rows, "majorKey", "majorId", ["majorName"])


def dim_subject(rows: DataFrame) -> DataFrame:
    return dimension(rows, "subjectKey", "subjectId", ["subjectName"])


def dim_subject_group(rows: DataFrame) -> DataFrame:
    return dimension(rows, "subjectGroupKey", "subjectGroupId", ["subjectGroupName", "subjectCombination"])


def dim_selection_method(rows: DataFrame) -> DataFrame:
    return dimension(rows, "selectionMethodKey", "selectionMethodId", ["selectionMethodName"])


def dim_grading_scale(rows: DataFrame) -> DataFrame:
    return dimension(rows, "gradingScaleKey", "gradingScaleId", ["value", "description"])


def fact_benchmark(benchmark: DataFrame, dims: dict[str, DataFrame], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Scores with keys, the major's mean, its change to the year before and two rankings."""
    resolved = star_resolve(
        benchmark.select("schoolId", "majorId", "subjectGroupId", "selectionMethodId", "gradingScaleId", "year", "score"),
        [
            Dim(dims["dim_time"], "year", "year", ("timeKey",)),
            Dim(dims["dim_school"], "schoolId", "schoolId", ("schoolKey",)),
            Dim(dims["dim_major"], "majorId", "majorId", ("majorKey",)),
            Dim(dims["dim_subject_group"], "subjectGroupId", "subjectGroupId", ("subjectGroupKey",)),
            Dim(dims["dim_selection_method"], "selectionMethodId", "selectionMethodId", ("selectionMethodKey",)),
            Dim(dims["dim_grading_scale"], "gradingScaleId", "gradingScaleId", ("gradingScaleKey",)),
        ],
    )
    method = ["selectionMethodKey", "gradingScaleKey"]
    # Ids order rows without a key; a key settles its id, so those are not carried through every step.
    spark, named = resolved.sparkSession, ("school", "major", "subjectGroup")
    ids = [F.when(F.col(f"{d}Key").isNull(), F.col(f"{d}Id")).alias(f"{d}Id") for d in named]
    # Read by each of the steps below, so it is made once. No group has more rows than all.
    slim = resolved.select("timeKey", *[f"{d}Key" for d in named], *method, *ids, "score")
    kept, folder = stored(slim, "facts")
    del resolved, slim
    release(spark)
    n_rows, facts = kept.count(), kept
    # Three of the measures compare rows of one school and method: they are shuffled once for these, unless that is too much for a task.
    if hot_groups(kept, ["schoolKey", *method], group_rows, n_rows) is None:
        facts = kept.repartition("schoolKey", *method)
    facts = windows.group_mean(facts, ["timeKey", "schoolKey", "majorKey", *method], "score", "avgScoreByMajor", group_rows=group_rows, n_rows=n_rows, counted=kept)
    facts = windows.period_delta(
        facts, ["schoolKey", "majorKey", *method, "subjectGroupKey"], "timeKey", "avgScoreByMajor", "yearlyScoreGap",
        ties=("schoolId", "majorId", "subjectGroupId", "score"), group_rows=group_rows, n_rows=n_rows, counted=kept,
    )
    facts = windows.rank_in_group(
        facts, ["timeKey", "schoolKey", *method], ["-avgScoreByMajor", "majorKey"], "rankAmongMajors", dense=True,
        group_rows=group_rows, n_rows=n_rows, counted=kept,
    )
    facts = windows.rank_in_group(
        facts, ["timeKey", "majorKey", *method], ["-avgScoreByMajor", "schoolKey"], "rankAmongSchools", dense=True,
        group_rows=group_rows, n_rows=n_rows, counted=kept,
    )
    order = ["timeKey", "schoolKey", "majorKey", *method, "subjectGroupKey", "score", "schoolId", "majorId"]
    numbered = surrogate_key(facts, "benchmarkKey", order)
    discard(spark, folder)
    del facts
    release(spark)
    return numbered.select(
        "benchmarkKey", "subjectGroupKey", "timeKey", "majorKey", "schoolKey", *method,
        *[F.col(c).cast("float").alias(c) for c in ("score", "avgScoreByMajor", "yearlyScoreGap")],
        "rankAmongMajors", "rankAmongSchools",
    )


#: Students per key and bin: what the two distributions are made from. Counts of changes add up to the counts of the table.
BY_SUBJECT = ["regionId", "subjectId", "year", "scoreThreshold"]
BY_GROUP = ["regionId", "subjectGroupId", "year", "scoreRange"]


def count_by_subject(scores: DataFrame, weight: str | None = None) -> DataFrame:
    """``BY_SUBJECT`` and quantity, over 0.2 steps."""
    # Exploded as entries: under an explode of a plain column Spark adds an emptiness
    # filter, which would parse a map that is not stored yet once more.
    weights = [weight] if weight else []
    entries = scores.select("regionId", "year", *weights, F.explode(F.map_entries("scores")).alias("__e"))
    each = entries.select("regionId", "year", *weights, F.col("__e.key").alias("subjectId"), F.col("__e.value").alias("score"))
    return agg.histogram(each, "score", "0.2", BY_SUBJECT[:3], BY_SUBJECT[3], "quantity", weight)


def distribution_by_subject(counted: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    facts = star_resolve(
        counted,
        [
            Dim(dims["dim_region"], "regionId", "regionId", ("regionKey",)),
            Dim(dims["dim_subject"], "subjectId", "subjectId", ("subjectKey",)),
            Dim(dims["dim_time"], "year", "year", ("timeKey",)),
        ],
    )
    order = ["timeKey", "regionKey", "subjectKey", "scoreThreshold", "regionId", "subjectId", "year"]
    return surrogate_key(facts, "SDBSKey", order).select(
        "SDBSKey", "regionKey", "subjectKey", "timeKey",
        F.col("scoreThreshold").cast("float"), F.col("quantity").cast("float"),
    )


def fact_score_distribution_by_subject(scores: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Students per region, subject, year and 0.2 step. Counted first, keys resolved after."""
    return distribution_by_subject(count_by_subject(scores), dims)


def members_by_id(groups: DataFrame, subjects: DataFrame) -> DataFrame:
    """(subjectGroupId, member, n_members) with subject ids.

    Names are compared trimmed and without case. A name that is no subject gets -1, which
    no student has, so its group is never complete.
    """
    named = groups.select("subjectGroupId", F.explode(F.array_distinct(split_trim("subjectCombination", "-"))).alias("name"))
    ids = subjects.select(F.lower(F.trim("subjectName")).alias("low"), "subjectId")
    found = named.withColumn("low", F.lower(F.trim("name"))).join(ids, "low", "left")
    members = found.select("subjectGroupId", F.coalesce("subjectId", F.lit(-1)).alias("member")).distinct()
    sizes = members.groupBy("subjectGroupId").agg(F.count("member").cast("int").alias("n_members"))
    return members.join(sizes, "subjectGroupId")


def count_by_group(scores: DataFrame, members: DataFrame, weight: str | None = None) -> DataFrame:
    """``BY_GROUP`` and quantity, over whole totals of the students who have all of a group's subjects."""
    keep = ["regionId", "year", *([weight] if weight else [])]
    totals = agg.complete_sum_of_maps(scores, keep, "scores", members, "subjectGroupId", "total")
    return agg.histogram(totals, "total", "1", BY_GROUP[:3], BY_GROUP[3], "quantity", weight)


def distribution_by_group(counted: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    facts = star_resolve(
        counted,
        [
            Dim(dims["dim_region"], "regionId", "regionId", ("regionKey",)),
            Dim(dims["dim_subject_group"], "subjectGroupId", "subjectGroupId", ("subjectGroupKey",)),
            Dim(dims["dim_time"], "year", "year", ("timeKey",)),
        ],
    )
    order = ["timeKey", "regionKey", "subjectGroupKey", "scoreRange", "regionId", "subjectGroupId", "year"]
    return surrogate_key(facts, "SDBSGKey", order).select(
        "SDBSGKey", "regionKey", "subjectGroupKey", "timeKey",
        F.col("scoreRange").cast("float"), F.col("quantity").cast("float"),
    )


def fact_score_distribution_by_subject_group(scores: DataFrame, groups: DataFrame, subjects: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Students per region, group, year and whole total, over students who have all the
    group's subjects."""
    return distribution_by_group(count_by_group(scores, members_by_id(groups, subjects)), dims)
