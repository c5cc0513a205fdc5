"""Posts, their entities and topics: bridges, dictionaries and descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.minitext import split_labels
from lakemill.functions.spans import clean_entities, tag_types
from lakemill.operators.joins import dictionary_join
from lakemill.operators.bounds import checked_broadcast

# Entity types and topics with their descriptions.
ENTITY_DETAIL = {
    "ORG": "ORGANIZATION : Tổ chức/Trường (ví dụ: Trường Đại học Bách khoa Hà Nội, Viện Công nghệ, các viện/khoa/bộ môn)",
    "PRO": "PROGRAM : Chương trình đào tạo (ví dụ: Chương trình Tiên tiến, Chương trình KSCLC, ELITECH)",
    "MAJ": "MAJOR : Ngành học, chuyên ngành, nghề nghiệp (ví dụ: Khoa học máy tính, Công nghệ thông tin, Kỹ thuật Điện tử - Viễn thông, Bác sĩ)",
    "SCO": "SCORE : Điểm số (ví dụ: 27.5 điểm, Điểm chuẩn 28)",
    "DATE": "DATE : Thời gian (ví dụ: Năm 2024, Năm 2025, 15/8/2024)",
    "EX": "EXAM : Kỳ thi (ví dụ: Kỳ thi đánh giá năng lực, TOEIC, IELTS, TOPIK)",
    "LOC": "LOCATION : Địa điểm (ví dụ: Hà Nội, Thành phố Hồ Chí Minh)",
    "FEE": "FEE : Học phí/Chi phí (ví dụ: Học phí, Mức đóng, Học bổng)",
    "SUBJ": "SUBJECT : Môn học (ví dụ: Toán, Lý, Hóa)",
    "TERM": "TERM : Tổ hợp môn (ví dụ: A1, B1)",
    "SAL": "SALARY : Lương (ví dụ: Mức lương, Thu nhập)",
}
TOPIC_DETAIL = {
    "MAJOR": "Ngành học, chuyên ngành",
    "SUBJECT_COMBINATION": "Tổ hợp môn thi (A, B, C, D)",
    "TUITION": "Học phí, học bổng",
    "CERTIFICATE": "IELTS, TOEFL, SAT, kỳ thi năng lực",
    "UNIVERSITY": "Thông tin trường",
    "STUDENT_LIFE": "Ký túc xá, CLB, làm thêm",
    "CAREER": "Nghề nghiệp, lương",
    "STUDY": "Phương pháp học, môn học ĐH",
    "LANGUAGE": "Tiếng Anh, ngoại ngữ",
    "OTHER": "Khác",
}
ENTITY_FALLBACK = "Entity type: "
TOPIC_FALLBACK = "Chủ đề khác"


def describe(df: DataFrame, column: str, details: dict[str, str], name: str, fallback) -> DataFrame:
    """Add the description of each dictionary member, or the fallback text.

    ``details`` is a short constant, so it is broadcast.
    """
    table = df.sparkSession.createDataFrame(list(details.items()), f"__k string, {name} string")
    joined = df.join(F.broadcast(table), F.col(column) == F.col("__k"), "left").drop("__k")
    return joined.withColumn(name, F.coalesce(F.col(name), fallback))


def describe_entities(df: DataFrame) -> DataFrame:
    return describe(df, "entityType", ENTITY_DETAIL, "entityDetail", F.concat(F.lit(ENTITY_FALLBACK), F.col("entityType")))


def describe_topics(df: DataFrame) -> DataFrame:
    return describe(df, "topicName", TOPIC_DETAIL, "topicDetail", F.lit(TOPIC_FALLBACK))


def entity_members(posts: DataFrame, tags: str) -> DataFrame:
    """Distinct entity types met in the posts."""
    return posts.select(F.explode(tag_types(tags)).alias("entityType")).distinct()


def topic_members(posts: DataFrame, topics: str) -> DataFrame:
    return posts.select(F.explode(split_labels(topics)).alias("topicName")).distinct()


def post_entities(posts: DataFrame, post: str, tags: str, text: str) -> DataFrame:
    """(post, entityOrder, entityType, entityName), order by type and name within the post.

    A post is one row, so its entities are sorted and numbered in place, without a shuffle.
    """
    return posts.select(post, F.posexplode(clean_entities(tags, text)).alias("__i", "__e")).select(
        post,
        (F.col("__i") + 1).alias("entityOrder"),
        F.col("__e.entityType").alias("entityType"),
        F.col("__e.entityName").alias("entityName"),
    )


def bridge_entity(posts: DataFrame, entities: DataFrame, post: str, tags: str, text: str) -> DataFrame:
    """Post–entity rows with the dictionary's ids; types the dictionary lacks are left out."""
    found = post_entities(posts, post, tags, text)
    return dictionary_join(found, entities, "entityType", ["entityID"]).select(
        post, "entityID", "entityOrder", "entityName", F.lit(None).cast("string").alias("entityNameNormalized")
    )


def bridge_topic(posts: DataFrame, topics: DataFrame, post: str, labels: str) -> DataFrame:
    """Post–topic rows, each topic once per post."""
    each = posts.select(post, F.explode(split_labels(labels)).alias("topicName"))
    return each.join(checked_broadcast(topics.select("topicID", "topicName")), "topicName", "inner").select(post, "topicID")
