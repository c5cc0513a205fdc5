"""Schemas of the silver and gold tables, with the columns they are partitioned by."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "map<int,double>": T.MapType(T.IntegerType(), T.DoubleType()),
}
_AUDIT = "created_at timestamp, updated_at timestamp"


def _table(columns: str, partition_by: str = "") -> tuple[T.StructType, list[str]]:
    """Schema of a column list as in DDL (no session needed), and the partition columns."""
    fields = [c.split(" ") for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields]), partition_by.split()


# Table and column names of the data model.
SILVER = {
    "school": _table(f"schoolId string, schoolName string, province string, {_AUDIT}"),
    "major": _table(f"majorId string, majorName string, {_AUDIT}"),
    "major_group": _table(f"majorGroupId int, majorGroupName string, {_AUDIT}"),
    "subject_group": _table(f"subjectGroupId int, subjectGroupName string, subjectCombination string, {_AUDIT}"),
    "subject": _table(f"subjectId int, subjectName string, {_AUDIT}"),
    "selection_method": _table(f"selectionMethodId int, selectionMethodName string, {_AUDIT}"),
    "grading_scale": _table(f"gradingScaleId int, value float, description string, {_AUDIT}"),
    "region": _table(f"regionId string, regionName string, {_AUDIT}"),
    "benchmark": _table(
        "benchmarkId bigint, schoolId string, majorId string, subjectGroupId int, selectionMethodId int, gradingScaleId int, "
        f"score double, {_AUDIT}, year int",
        "year",
    ),
    "student_scores": _table(f"studentId string, regionId string, scores map<int,double>, {_AUDIT}, year int", "year"),
    "article": _table(
        "articleID string, description string, author string, url string, timePublish timestamp, likeCount int, commentCount int, shareCount int, "
        f"type string, {_AUDIT}, timePublish_day date",
        "timePublish_day",
    ),
    # Partitioned by day only: a folder per article would make more folders than files are worth.
    "comment": _table(
        "commentID bigint, articleID string, name string, tagName string, urlUser string, comment string, commentTime timestamp, commentLike int, "
        f"levelComment int, replyTo string, numberOfReply int, {_AUDIT}, commentTime_day date",
        "commentTime_day",
    ),
    "result_multi_model": _table(
        "postID string, timePublish timestamp, description_Normalized string, Label_NER string, Label_Topic string, Label_Intent string, "
        f"likeCount int, commentCount int, shareCount int, type string, {_AUDIT}, timePublish_day date",
        "timePublish_day",
    ),
    "student_scores_ingest_log": _table("path string, year int, processed_at timestamp"),
    "tiktok_posts_files_log": _table("file_path string, load_time timestamp"),
    "tiktok_comments_files_log": _table("file_path string, load_time timestamp"),
    "fb_posts_files_log": _table("file_path string, load_time timestamp"),
    "fb_comments_files_log": _table("file_path string, load_time timestamp"),
}
GOLD_STAR = {
    "dim_time": _table("timeKey int, day int, month int, year int"),
    "dim_region": _table("regionKey int, regionId string, regionName string"),
    "dim_school": _table("schoolKey int, schoolId string, schoolName string, province string"),
    "dim_major": _table("majorKey int, majorId string, majorName string"),
    "dim_subject": _table("subjectKey int, subjectId int, subjectName string"),
    "dim_subject_group": _table("subjectGroupKey int, subjectGroupId int, subjectGroupName string, subjectCombination string"),
    "dim_selection_method": _table("selectionMethodKey int, selectionMethodId int, selectionMethodName string"),
    "dim_grading_scale": _table("gradingScaleKey int, gradingScaleId int, value float, description string"),
    "fact_benchmark": _table(
        "benchmarkKey bigint, subjectGroupKey int, majorKey int, schoolKey int, selectionMethodKey int, gradingScaleKey int, "
        "score float, avgScoreByMajor float, yearlyScoreGap float, rankAmongMajors int, rankAmongSchools int, timeKey int",
        "timeKey",
    ),
    "fact_score_distribution_by_subject": _table(
        "SDBSKey bigint, regionKey int, subjectKey int, scoreThreshold float, quantity float, timeKey int", "timeKey"
    ),
    "fact_score_distribution_by_subject_group": _table(
        "SDBSGKey bigint, regionKey int, subjectGroupKey int, scoreRange float, quantity float, timeKey int", "timeKey"
    ),
}
GOLD_SOCIAL = {
    "Entity": _table(f"entityID int, entityType string, entityDetail string, {_AUDIT}"),
    "Topic": _table(f"topicID int, topicName string, topicDetail string, {_AUDIT}"),
    "Post": _table(
        f"postID string, description string, timePublish timestamp, likeCount int, commentCount int, shareCount int, intent string, type string, {_AUDIT}, "
        "timePublish_day date",
        "timePublish_day",
    ),
    "Post_Entity": _table(
        f"postID string, entityID int, entityOrder int, entityName string, entityNameNormalized string, {_AUDIT}",
        "entityID",
    ),
    "Post_Topic": _table(f"postID string, topicID int, {_AUDIT}"),
    "Comment_Sentiment": _table(
        "postID string, commentID bigint, comment string, sentiment string, commentTime timestamp, commentLike int, levelComment int, "
        f"numberOfReply int, {_AUDIT}"
    ),
}
