"""The whole flow, from CSV files to gold tables, on a small hand-written set."""

import pytest
from pyspark.sql import functions as F

from lakemill.catalog import GOLD_SOCIAL, GOLD_STAR, SILVER
from lakemill.operators import scoring
from lakemill.plans import loads, star
from lakemill.sinks.tables import Lake

from .conftest import RUN_TS, rows
from .test_files import put

LATER = "2025-07-01 00:00:00"


def write_bronze(base):
    for year in (2023, 2024):
        put(f"{base}/trường/{year}.csv", "STT,TenTruong,MaTruong,TinhThanh\n1,Đại học A,AAA,Hà Nội\n2,Đại học B,BBB,Huế\n3,,CCC,Huế\n")
    put(f"{base}/ngành.csv", "ma,ten\n7480201.0, CNTT \n7480201,CNTT\nnan,x\nM2,Y khoa\n,trống\n")
    put(f"{base}/nhóm.csv", "stt,ten,ma\n1,Máy tính,748\n2,Máy tính,748\n3,Sai,x\n")
    put(f"{base}/tổ hợp.csv", "id,ten,mon\n1,A00,Toán-Lý-Hoá\n2,D01,Toán - Ngữ văn-Anh\n3,A00,Toán-Lý-Hoá\nx,B00,Toán\n")
    put(
        f"{base}/điểm chuẩn/2023.csv",
        "Nam,MaTruong,PhuongThuc,MaNganh,KhoiThi,DiemChuan,PhanLoaiThangDiem\n"
        "2023,AAA,Điểm thi THPT năm 2023,7480201,A00,26.5,thang 30\n"
        "2023,AAA,Điểm thi THPT năm 2023,7480201,A00,26.5,thang 30\n"
        "2023,AAA,Điểm thi THPT năm 2023,7480201,A00,27.0,thang 30\n"
        "2023,AAA,Điểm thi THPT năm 2023,M2,,28.0,thang 30\n"
        "2023,BBB,Điểm thi THPT,7480201,A00,25.0, thang 30 \n"
        "2023,BBB,Điểm thi THPT,7480201,A00,cao,thang 30\n",
    )
    put(
        f"{base}/điểm chuẩn/2024.csv",
        "Nam,MaTruong,PhuongThuc,MaNganh,KhoiThi,DiemChuan,PhanLoaiThangDiem\n"
        "2024,AAA,Điểm thi THPT năm 2024 đợt 1,7480201,A00,27.25,thang 30\n"
        "2024,AAA,Học bạ,7480201,,80,thang 100 điểm\n",
    )
    put(f"{base}/region.csv", "id,ten\n1,Hà Nội\n48,Đà Nẵng\n1,Hà Nội\n")
    put(f"{base}/điểm/2023/a b.csv", 'SBD,DiemThi\n01000001,"Toán:8.2,Lý:7.4,Hoá:8.4"\n01000002,"Toán:0.6,Lý:x"\n48000001,""\n')
    put(f"{base}/điểm/2024/a.csv", 'SBD,DiemThi\n01000001,"Toán:9,Toán:10.0,Lạ:3"\n')
    put(
        f"{base}/tt/posts/1.csv",
        "ID,Description,Author,Url,TimePublish,Like,Comment,Share\n"
        " t1 ,Trường Đại Học Bách Khoa tốt không?,u,http://t/1,15-03-2024,1.2K,3,abc\n"
        "t2,,u,http://t/2,3 Tháng 4, 3M,,1\n",
    )
    put(
        f"{base}/tt/comments/1.csv",
        "ID_Post,Name,TagName,URL,Comment,Time,Likes,LevelComment,RepliedTo,NumberOfReplies\n"
        "t1,N,@n,http://n,rất tốt,5-3-2024,2,No,---,1\nt1,M,@m,http://m,dở tệ,2 ngày trước,x,Yes,N,\n,M,@m,http://m,mất,1-1-2024,1,No,,\n",
    )
    put(f"{base}/tt/comments/2.csv", "Name,Comment\nN,không có bài\n")
    put(
        f"{base}/fb/posts/1.csv",
        "ID,Description,Author,Url,TimePublish,Like,Share,Comment\n"
        'f1,Học phí ngành Y,p,http://f/1,"Thứ Hai, 15 Tháng 3, 2024 lúc 10:30",5,1,2\n',
    )
    put(f"{base}/fb/comments/1.csv", "Id_post,Other\nf1,x\n")
    return loads.Bronze(
        schools=[f"{base}/trường/2023.csv", f"{base}/trường/2024.csv"],
        majors=f"{base}/ngành.csv",
        subject_groups=f"{base}/tổ hợp.csv",
        benchmarks=f"{base}/điểm chuẩn",
        regions=f"{base}/region.csv",
        major_groups=f"{base}/nhóm.csv",
        student_scores=f"{base}/điểm",
        tiktok_posts=f"{base}/tt/posts",
        tiktok_comments=f"{base}/tt/comments",
        facebook_posts=f"{base}/fb/posts",
        facebook_comments=f"{base}/fb/comments",
    )


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("flow"))
    bronze = write_bronze(base)
    silver = Lake(spark, "t_silver", f"{base}/silver", SILVER)
    gold = Lake(spark, "t_gold", f"{base}/gold", GOLD_STAR)
    social = Lake(spark, "t_social", f"{base}/social", GOLD_SOCIAL)
    loads.bronze_to_silver(spark, silver, bronze, RUN_TS)
    return bronze, silver, gold, social, base


def test_reference_tables(flow):
    _, silver, *_ = flow
    assert rows(silver.read("school"), "schoolId", "schoolName") == [("AAA", "Đại học A"), ("BBB", "Đại học B")]
    assert rows(silver.read("major"), "majorId", "majorName") == [("7480201", "CNTT"), ("M2", "Y khoa")]
    assert rows(silver.read("major_group"), "majorGroupId") == [(748,)]
    assert rows(silver.read("subject_group"), "subjectGroupId") == [(1,), (2,)]
    assert rows(silver.read("subject"), "subjectId", "subjectName") == [(1, "Anh"), (2, "Hoá"), (3, "Lý"), (4, "Ngữ văn"), (5, "Toán")]
    assert rows(silver.read("selection_method"), "selectionMethodId", "selectionMethodName") == [(1, "Học bạ"), (2, "Điểm thi THPT")]
    assert rows(silver.read("grading_scale"), "value", "description") == [(100.0, "thang 100 điểm"), (30.0, "thang 30")]
    assert rows(silver.read("region"), "regionId") == [("01",), ("48",)]


def test_benchmark_averages_distinct_scores_and_merges(spark, flow):
    bronze, silver, *_ = flow
    want = [
        ("AAA", "7480201", 1, 2023, 26.75), ("AAA", "7480201", 1, 2024, 27.25), ("AAA", "7480201", None, 2024, 80.0),
        ("AAA", "M2", None, 2023, 28.0), ("BBB", "7480201", 1, 2023, 25.0),
    ]
    columns = ["schoolId", "majorId", "subjectGroupId", "year", "score"]
    assert rows(silver.read("benchmark"), *columns) == sorted(want, key=repr)
    ids = rows(silver.read("benchmark"), "benchmarkId")
    assert len(set(ids)) == 5 and all(i[0] is not None for i in ids)
    loads.load_benchmark(spark, silver, bronze, LATER)
    assert rows(silver.read("benchmark"), *columns) == sorted(want, key=repr)
    assert rows(silver.read("benchmark"), "benchmarkId") == ids
    stamps = silver.read("benchmark").select(F.min("created_at"), F.min("updated_at")).first()
    assert [str(x) for x in stamps] == [RUN_TS, LATER]


def test_student_scores_replace_their_rows(spark, flow):
    bronze, silver, *_, base = flow
    want = [
        ("010000012023", "01", 2023, {5: 8.2, 3: 7.4, 2: 8.4}), ("010000012024", "01", 2024, {5: 10.0}),
        ("010000022023", "01", 2023, {5: 0.6}), ("480000012023", "48", 2023, {}),
    ]
    got = sorted((r["studentId"], r["regionId"], r["year"], r["scores"]) for r in silver.read("student_scores").collect())
    assert got == want
    put(f"{base}/điểm/2023/b.csv", 'SBD,DiemThi\n48000001,"Anh:5"\n')
    loads.load_student_scores(spark, silver, bronze, LATER)
    loads.load_student_scores(spark, silver, bronze, LATER)
    got = {r["studentId"]: r["scores"] for r in silver.read("student_scores").collect()}
    assert len(got) == 4 and got["480000012023"] == {1: 5.0} and got["010000012023"] == want[0][3]


def test_articles_and_comments(spark, flow):
    bronze, silver, *_, base = flow
    got = rows(silver.read("article"), "articleID", "likeCount", "commentCount", "shareCount", "type", F.col("timePublish").cast("string"))
    assert got == [
        ("f1", 5, 2, 1, "facebook", "2024-03-15 10:30:00"),
        ("t1", 1200, 3, 0, "TikTok", "2024-03-15 00:00:00"),
        ("t2", 3_000_000, 0, 1, "TikTok", RUN_TS),
    ]
    columns = ["commentID", "articleID", "comment", "commentLike", "levelComment", "numberOfReply"]
    want = [(1, "t1", "dở tệ", 0, 2, 0), (2, "t1", "rất tốt", 2, 1, 1), (3, "f1", None, 0, 1, 0)]
    found = rows(silver.read("comment"), *columns)
    assert [(c[0], c[1], c[2] or None, *c[3:]) for c in found] == want
    put(
        f"{base}/fb/posts/2.csv",
        "ID,Description,Author,Url,TimePublish,Like,Share,Comment\n"
        'f9,Học phí mới,q,http://f/1,"15 Tháng 3",50,10,20\nf2,Khác,q,,2024-05-01,1,1,1\n',
    )
    loads.load_articles(spark, silver, bronze, LATER)
    loads.load_comments(spark, silver, bronze, LATER)
    face = silver.read("article").filter("type = 'facebook'")
    assert rows(face, "articleID", "description", "author", "likeCount", F.col("timePublish").cast("string")) == [
        ("f1", "Học phí mới", "p", 50, "2025-03-15 00:00:00"), ("f2", "Khác", "q", 1, "2024-05-01 00:00:00"),
    ]
    assert silver.read("comment").count() == 3


def test_star(flow):
    _, silver, gold, *_ = flow
    loads.silver_to_star(silver, gold)
    assert rows(gold.read("dim_time"), "timeKey", "day", "month", "year") == [(1, 1, 1, 2023), (2, 1, 1, 2024)]
    fact = gold.read("fact_benchmark")
    assert rows(fact, "benchmarkKey") == [(i,) for i in range(1, 6)]
    got = rows(fact, "timeKey", "schoolKey", "majorKey", "subjectGroupKey", "score", "yearlyScoreGap", "rankAmongMajors", "rankAmongSchools")
    assert got == sorted(
        [
            (1, 1, 1, 1, 26.75, 0.0, 2, 1), (1, 1, 2, None, 28.0, 0.0, 1, 1), (1, 2, 1, 1, 25.0, 0.0, 1, 2),
            (2, 1, 1, 1, 27.25, 0.5, 1, 1), (2, 1, 1, None, 80.0, 0.0, 1, 1),
        ],
        key=repr,
    )
    assert gold.partitions("fact_benchmark") == ["timeKey"]
    group = gold.read("fact_score_distribution_by_subject_group")
    assert rows(group, "regionKey", "subjectGroupKey", "timeKey", "scoreRange", "quantity") == [(1, 1, 1, 24.0, 1.0)]
    subject = gold.read("fact_score_distribution_by_subject").join(gold.read("dim_subject"), "subjectKey").filter("subjectName = 'Toán'")
    got = [(k, t, round(s, 1), q) for k, t, s, q in rows(subject, "regionKey", "timeKey", "scoreThreshold", "quantity")]
    assert got == [(1, 1, 0.6, 1.0), (1, 1, 8.2, 1.0), (1, 2, 10.0, 1.0)]


def test_fact_is_the_same_through_the_distributed_sort(flow):
    _, silver, gold, *_ = flow
    loads.silver_to_star(silver, gold)
    dims = {t: gold.read(t) for t in gold.list_tables() if t.startswith("dim_")}
    one = star.fact_benchmark(silver.read("benchmark"), dims)
    other = star.fact_benchmark(silver.read("benchmark"), dims, group_rows=0)
    assert rows(one) == rows(other.select(*one.columns))


ALIASES = [("đại học bách khoa", 1, "bách khoa", 1), ("bộ y tế", 2, "byt", 1)]


def test_social(spark, flow):
    _, silver, _, gold, _ = flow
    factory = scoring.shape_scorer({"Học": "UNIVERSITY", "phí": "TUITION"})
    loads.score_articles(silver, factory, RUN_TS)
    loads.score_articles(silver, factory, RUN_TS)
    results = silver.read("result_multi_model")
    assert results.count() == silver.read("article").count()
    blank = results.filter("postID = 't2'").first()
    assert (blank["description_Normalized"], blank["Label_NER"], blank["Label_Topic"], blank["Label_Intent"]) == ("", "O", "None", "Unknown")
    loads.load_social(silver, gold, RUN_TS)
    counts = {t: gold.read(t).count() for t in gold.list_tables()}
    loads.load_social(silver, gold, LATER)
    assert {t: gold.read(t).count() for t in gold.list_tables()} == counts
    assert rows(gold.read("Entity"), "entityID", "entityType") == [(1, "ORG")]
    assert ("TUITION", "Học phí, học bổng") in rows(gold.read("Topic"), "topicName", "topicDetail")
    named = gold.read("Post_Entity").filter("postID = 't1'")
    # A capital Đ is no ASCII capital, so it parts the two names.
    assert rows(named, "entityOrder", "entityName", "entityNameNormalized") == [(1, "Học Bách Khoa", None), (2, "Trường", None)]
    alias_df = spark.createDataFrame(ALIASES, "grp string, key_ord int, variant string, var_ord int")
    before = gold.read("Post_Entity").count()
    report = loads.normalise_names(gold, alias_df, "ORG", LATER)
    assert ("trường - đại học bách khoa", 1, 1) in rows(report)
    assert gold.read("Post_Entity").count() == before
    assert rows(loads.reset_names(gold, LATER, "MAJ"), "entityType", "not_null_count") == [("ORG", 1)]
    assert rows(loads.reset_names(gold, LATER, "ORG"), "entityType", "not_null_count") == [("ORG", 0)]
    loads.normalise_names(gold, alias_df, "ORG", LATER)
    assert rows(loads.reset_names(gold, LATER), "not_null_count") == [(0,)]


def test_comment_sentiment_in_batches(flow):
    _, silver, _, gold, _ = flow
    factory = scoring.lexicon_scorer(["tốt"], ["tệ"])
    loads.score_comments(silver, gold, factory, RUN_TS, size=1)
    assert rows(gold.read("Comment_Sentiment"), "commentID", "sentiment") == [(1, "NEG")]
    for _ in range(2):
        loads.score_comments(silver, gold, factory, RUN_TS)
    assert rows(gold.read("Comment_Sentiment"), "commentID", "sentiment") == [(1, "NEG"), (2, "POS")]


def test_a_failing_scorer_gives_defaults_for_its_row_only(spark):
    import pandas as pd

    def factory():
        def score(texts):
            if texts.str.contains("boom").any():
                raise ValueError("boom")
            return pd.DataFrame({"description_Normalized": texts.str.upper(), "Label_NER": "B-A", "Label_Topic": "T", "Label_Intent": "I"})

        return score

    df = spark.createDataFrame([(1, "ok"), (2, "boom"), (3, " "), (4, None)], "id int, t string").coalesce(1)
    marked = scoring.score_posts(df, "t", factory, failed="failed")
    assert rows(marked.filter("failed"), "id") == [(2,)]
    got = rows(scoring.score_posts(df, "t", factory), "id", "description_Normalized", "Label_NER", "Label_Intent")
    assert got == [(1, "OK", "B-A", "I"), (2, "boom", "O", "Unknown"), (3, "", "O", "Unknown"), (4, "", "O", "Unknown")]
