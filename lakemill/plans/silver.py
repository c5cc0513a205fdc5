"""Bronze files → silver tables, one function per table.

Each takes the raw rows (all columns strings) and returns clean, typed, keyed rows.
``run_ts`` is the time of the run, used for the audit columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions import scalar as s
from lakemill.functions.minitext import split_trim
from lakemill.operators import changes, clean, joins
from lakemill.operators.aggregates import mean_of_distinct
from lakemill.operators.keys import continue_ids, grow_dictionary, hash_key

BENCHMARK_KEY = ["schoolId", "majorId", "subjectGroupId", "selectionMethodId", "gradingScaleId", "year"]
BENCHMARK_NULLS = {"subjectGroupId": -1}
TIKTOK, FACEBOOK = "TikTok", "facebook"


def school(raw: DataFrame, run_ts: str) -> DataFrame:
    rows = raw.select("TenTruong", "MaTruong", "TinhThanh").distinct()
    named = rows.select(
        F.col("MaTruong").alias("schoolId"), F.col("TenTruong").alias("schoolName"), F.col("TinhThanh").alias("province")
    )
    return clean.with_audit(clean.require(named, ["schoolId", "schoolName"]), run_ts)


def major(raw: DataFrame, run_ts: str) -> DataFrame:
    first = clean.by_position(raw, {0: ("majorId", "string"), 1: ("majorName", "string")})
    named = first.select(s.strip_dot_zero("majorId").alias("majorId"), F.trim("majorName").alias("majorName"))
    kept = clean.drop_sentinels(clean.non_blank(named, ["majorId", "majorName"]), "majorId", ("nan",))
    return clean.with_audit(clean.dedup_by(kept, [F.lower("majorId")], ["majorId", "majorName"]), run_ts)


def major_group(raw: DataFrame, run_ts: str) -> DataFrame:
    rows = clean.by_position(raw, {2: ("majorGroupId", "int"), 1: ("majorGroupName", "string")})
    kept = clean.require(rows, ["majorGroupId", "majorGroupName"])
    return clean.with_audit(clean.dedup_by(kept, ["majorGroupId"], ["majorGroupName"]), run_ts)


def subject_group(raw: DataFrame, run_ts: str) -> DataFrame:
    names = ["subjectGroupId", "subjectGroupName", "subjectCombination"]
    rows = clean.by_position(raw, {0: (names[0], "int"), 1: (names[1], "string"), 2: (names[2], "string")})
    kept = clean.require(rows, names)
    return clean.with_audit(clean.dedup_by(kept, names[1:], names[:1]), run_ts)


def _grown(names: DataFrame, known: DataFrame | None, key: str, id_name: str) -> DataFrame:
    """Known members with their ids, and new ones numbered after the highest id: an id is never given out again."""
    fresh = grow_dictionary(known, names, key, id_name).select(F.col(id_name).cast("int").alias(id_name), key)
    return fresh if known is None else known.select(F.col(id_name).cast("int").alias(id_name), key).unionByName(fresh)


def subject(raw: DataFrame, run_ts: str, known: DataFrame | None = None) -> DataFrame:
    """Subjects named in the group combinations; new ones are numbered in lower-case order after the known."""
    combination = F.col(f"`{raw.columns[2]}`")
    names = clean.dedup_ignore_case(raw.select(F.explode(split_trim(combination, "-")).alias("subjectName")), "subjectName")
    lowered = names.withColumn("low", F.lower("subjectName"))
    if known is not None:
        lowered = lowered.join(known.select(F.lower("subjectName").alias("low")), "low", "left_anti")
    numbered = grow_dictionary(known.withColumn("low", F.lower("subjectName")) if known is not None else None, lowered, "low", "subjectId")
    fresh = numbered.select(F.col("subjectId").cast("int").alias("subjectId"), "subjectName")
    rows = fresh if known is None else known.select(F.col("subjectId").cast("int").alias("subjectId"), "subjectName").unionByName(fresh)
    return clean.with_audit(rows, run_ts)


def selection_method(raw: DataFrame, run_ts: str, known: DataFrame | None = None) -> DataFrame:
    names = raw.select(s.strip_year_suffix("PhuongThuc").alias("selectionMethodName"))
    distinct = clean.non_blank(names, ["selectionMethodName"]).distinct()
    return clean.with_audit(_grown(distinct, known, "selectionMethodName", "selectionMethodId"), run_ts)


def grading_scale(raw: DataFrame, run_ts: str, known: DataFrame | None = None) -> DataFrame:
    names = clean.non_blank(raw.select(F.trim("PhanLoaiThangDiem").alias("description")), ["description"]).distinct()
    rows = _grown(names, known, "description", "gradingScaleId")
    value = s.first_number("description").cast("float").alias("value")
    return clean.with_audit(rows.select("gradingScaleId", value, "description"), run_ts)


def region(raw: DataFrame, run_ts: str) -> DataFrame:
    rows = clean.by_position(raw, {0: ("regionId", "string"), 1: ("regionName", "string")})
    kept = clean.require(rows.withColumn("regionId", s.pad_code("regionId")), ["regionId", "regionName"])
    return clean.with_audit(clean.dedup_by(kept, ["regionId"], ["regionName"]), run_ts)


def benchmark(raw: DataFrame, methods: DataFrame, groups: DataFrame, scales: DataFrame) -> DataFrame:
    """Mean of the distinct scores per business key. A group name with several
    combinations keeps all of them."""
    rows = joins.left_lookup(raw, methods, s.strip_year_suffix("PhuongThuc"), "selectionMethodName", ["selectionMethodId"])
    rows = joins.left_lookup(rows, groups, "KhoiThi", "subjectGroupName", ["subjectGroupId"])
    rows = joins.left_lookup(rows, scales, F.trim("PhanLoaiThangDiem"), "description", ["gradingScaleId"])
    typed = rows.select(
        F.col("MaTruong").alias("schoolId"),
        F.col("MaNganh").alias("majorId"),
        "subjectGroupId",
        "selectionMethodId",
        "gradingScaleId",
        F.col("Nam").try_cast("int").alias("year"),
        F.col("DiemChuan").try_cast("double").alias("score"),
    )
    kept = clean.require(typed, [c for c in typed.columns if c != "subjectGroupId"])
    return mean_of_distinct(kept, BENCHMARK_KEY, "score", "score")


def benchmark_id():
    return {"benchmarkId": hash_key(BENCHMARK_KEY, BENCHMARK_NULLS)}


def student_scores(raw: DataFrame, subjects: DataFrame, path: str = "path") -> DataFrame:
    """One row per student and year; of copies the one from the last file stays.

    Subject names become ids through the subject table, read as the query runs.
    """
    rows = raw.select(
        F.concat("SBD", s.path_year(path).cast("string")).alias("studentId"),
        s.code_prefix("SBD").alias("regionId"),
        s.path_year(path).alias("year"),
        "DiemThi",
        F.col(path).alias("path"),
    )
    # By a hash first: ids begin alike, and sorts compare eight bytes before they look at a row.
    kept = clean.dedup_by(clean.require(rows, ["studentId", "year"]), [F.xxhash64("studentId"), "studentId"], ["-path", "-DiemThi"])
    return joins.maps_by_dictionary(kept, "DiemThi", subjects, "subjectName", "subjectId", "scores").select("studentId", "regionId", "year", "scores")


def _time(c, run_ts: str | None):
    return c if run_ts is None else F.coalesce(c, F.lit(run_ts).cast("timestamp"))


def tiktok_posts(raw: DataFrame, run_ts: str, unparsed_time: str | None = "run") -> DataFrame:
    """Posts; a time that cannot be read becomes the run's, or NULL with ``unparsed_time=None``."""
    rows = raw.select(
        F.trim("ID").alias("articleID"),
        F.col("Description").alias("description"),
        F.col("Author").alias("author"),
        F.col("Url").alias("url"),
        _time(s.parse_date("TimePublish"), run_ts if unparsed_time else None).alias("timePublish"),
        s.magnitude("Like").alias("likeCount"),
        s.magnitude("Comment").alias("commentCount"),
        s.magnitude("Share").alias("shareCount"),
        F.lit(TIKTOK).alias("type"),
    )
    return clean.with_audit(rows, run_ts)


def tiktok_comments(raw: DataFrame, run_ts: str, unparsed_time: str | None = "run") -> DataFrame:
    rows = raw.select(
        F.trim("ID_Post").alias("articleID"),
        F.col("Name").alias("name"),
        F.col("TagName").alias("tagName"),
        F.col("URL").alias("urlUser"),
        F.col("Comment").alias("comment"),
        _time(s.parse_comment_time("Time"), run_ts if unparsed_time else None).alias("commentTime"),
        s.int_or("Likes").alias("commentLike"),
        s.yes_level("LevelComment").alias("levelComment"),
        F.col("RepliedTo").alias("replyTo"),
        s.int_or("NumberOfReplies").alias("numberOfReply"),
        clean.column_or(raw, "source_file", "").alias("source_file"),
    )
    return clean.with_audit(clean.non_blank(rows, ["articleID"]), run_ts)


COMMENT = {
    "articleID": ("string", None),
    "name": ("string", None),
    "tagName": ("string", None),
    "urlUser": ("string", None),
    "comment": ("string", ""),
    "commentTime": ("timestamp", None),
    "commentLike": ("int", 0),
    "levelComment": ("int", 1),
    "replyTo": ("string", None),
    "numberOfReply": ("int", 0),
    "source_file": ("string", ""),
}


def facebook_comments(raw: DataFrame, run_ts: str) -> DataFrame:
    """A poorer source: only the post and, if there, the text; the rest gets its default."""
    slim = raw.select(
        F.trim("Id_post").alias("articleID"),
        clean.column_or(raw, "Comment", "").alias("comment"),
        clean.column_or(raw, "source_file", "").alias("source_file"),
    )
    return clean.with_audit(clean.non_blank(clean.align(slim, COMMENT), ["articleID"]), run_ts)


def number_comments(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Comment ids that go on from the highest one, in file and content order."""
    order = ["source_file", "articleID", "commentTime", "name", "comment", "tagName", "urlUser", "replyTo", "commentLike", "levelComment", "numberOfReply"]
    return continue_ids(rows, known, "commentID", order).drop("source_file")


def facebook_posts(raw: DataFrame, run_ts: str, unparsed_time: str | None = "run") -> DataFrame:
    time = F.coalesce(s.parse_long_date("TimePublish"), F.col("TimePublish").try_cast("timestamp"))
    rows = raw.select(
        *[F.trim(c).alias(n) for c, n in (("ID", "articleID"), ("Description", "description"), ("Author", "author"), ("Url", "url"))],
        _time(time, run_ts if unparsed_time else None).alias("timePublish"),
        s.int_or("Like").alias("likeCount"),
        s.int_or("Comment").alias("commentCount"),
        s.int_or("Share").alias("shareCount"),
        F.lit(FACEBOOK).alias("type"),
    )
    return clean.with_audit(rows, run_ts)


def merge_facebook_posts(articles: DataFrame, posts: DataFrame) -> DataFrame:
    """Update the posts whose url is known, add the others; posts without url are always new.

    Of several source rows of one url the latest counts. ``created_at`` and the author of
    a known post stay.
    """
    with_url = posts.filter(F.col("url").isNotNull())
    order = ["-timePublish", "-likeCount", "-commentCount", "-shareCount", "articleID", "description", "author"]
    columns = ["description", "timePublish", "likeCount", "shareCount", "commentCount", "updated_at"]
    columns += [c for c in articles.columns if c == "timePublish_day"]
    merged = changes.upsert(articles, with_url, ["url", "type"], columns, order)
    return merged.unionByName(posts.filter(F.col("url").isNull()).select(*articles.columns))
