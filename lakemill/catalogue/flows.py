"""The star loads end to end, on raw rows that look like the CSV files and hold the test tables."""

from pyspark.sql import functions as F

from lakemill.catalogue.measures import score_text
from lakemill.catalogue.registry import mean2, query, table, wide_table
from lakemill.operators import changes
from lakemill.plans import silver, social, star
from lakemill.session import cut, discard, release, stored

RUN_TS = "2025-01-01 00:00:00"


def raw_benchmark(spark, sf):
    lines = wide_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    year = F.year("o_orderdate").cast("string")
    return rows.select(
        year.alias("Nam"),
        F.col("l_suppkey").cast("string").alias("MaTruong"),
        F.concat("o_orderpriority", F.lit(" năm "), year, F.lit(" đợt 1")).alias("PhuongThuc"),
        F.col("p_type").alias("MaNganh"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("KhoiThi"),
        F.when(F.col("l_quantity") < 50, F.col("l_quantity").cast("int").cast("string")).otherwise("miễn").alias("DiemChuan"),
        F.when(F.col("l_linestatus") == "F", " thang 30").otherwise("thang 40 ").alias("PhanLoaiThangDiem"),
    )


def keyed(df, name, key, *attributes):
    """Dimension rows straight from a test table."""
    return star.dimension(df.select(F.col(name).cast("string").alias(key), *attributes).distinct(), key.replace("Id", "Key"), key, [])


@query(
    "fact_benchmark",
    f"""WITH raw AS (
          SELECT CAST(l_suppkey AS VARCHAR) AS school, p_type AS major, nullif(l_returnflag, 'N') AS grp, o_orderpriority AS method,
                 l_linestatus AS scale, year(o_orderdate) AS year, CAST(l_quantity AS DECIMAL(18,2)) AS q
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_quantity < 50),
        d AS (SELECT DISTINCT * FROM raw),
        b AS (SELECT school, major, grp, method, scale, year, {mean2("sum(q)", "count(*)")} AS score FROM d GROUP BY ALL),
        m AS (SELECT school, major, method, scale, year, {mean2("sum(CAST(score AS DECIMAL(18,2)))", "count(*)")} AS avg_score
              FROM b GROUP BY ALL),
        j AS (SELECT b.*, avg_score FROM b JOIN m USING (school, major, method, scale, year)),
        t AS (SELECT year, row_number() OVER (ORDER BY year) AS k FROM (SELECT DISTINCT year FROM b)),
        s AS (SELECT s_suppkey, row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS k FROM supplier),
        mj AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS k FROM (SELECT DISTINCT p_type FROM part)),
        r AS (SELECT CAST(t.k AS INTEGER) AS "timeKey", CAST(s.k AS INTEGER) AS "schoolKey", CAST(mj.k AS INTEGER) AS "majorKey",
                CASE grp WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS "subjectGroupKey", CAST(method[1] AS INTEGER) AS "selectionMethodKey",
                CASE scale WHEN 'F' THEN 1 ELSE 2 END AS "gradingScaleKey", score, avg_score FROM j JOIN t USING (year)
              JOIN s ON s_suppkey = CAST(school AS BIGINT) JOIN mj ON p_type = major)
      SELECT row_number() OVER (ORDER BY "timeKey", "schoolKey", "majorKey", "selectionMethodKey", "gradingScaleKey",
               "subjectGroupKey" NULLS FIRST) AS "benchmarkKey",
             "timeKey", "schoolKey", "majorKey", "subjectGroupKey", "selectionMethodKey", "gradingScaleKey", CAST(score AS FLOAT) AS score,
             CAST(avg_score AS FLOAT) AS "avgScoreByMajor",
             CAST(coalesce(CAST(avg_score AS DECIMAL(18,2)) - lag(CAST(avg_score AS DECIMAL(18,2))) OVER (PARTITION BY "schoolKey",
               "majorKey", "selectionMethodKey", "gradingScaleKey", "subjectGroupKey" ORDER BY "timeKey"), 0) AS FLOAT) AS "yearlyScoreGap",
             CAST(dense_rank() OVER (PARTITION BY "timeKey", "schoolKey", "selectionMethodKey", "gradingScaleKey"
               ORDER BY avg_score DESC, "majorKey") AS INTEGER) AS "rankAmongMajors",
             CAST(dense_rank() OVER (PARTITION BY "timeKey", "majorKey", "selectionMethodKey", "gradingScaleKey"
               ORDER BY avg_score DESC, "schoolKey") AS INTEGER) AS "rankAmongSchools" FROM r""",
)
def fact_benchmark(spark, sf):
    raw, raw_folder = stored(raw_benchmark(spark, sf), "raw")
    release(spark)
    methods, scales = silver.selection_method(raw, RUN_TS), silver.grading_scale(raw, RUN_TS)
    groups = spark.createDataFrame([(1, "A", "x"), (2, "R", "y")], "subjectGroupId int, subjectGroupName string, subjectCombination string")
    scores, scores_folder = stored(silver.benchmark(raw, methods, groups, scales), "scores")
    discard(spark, raw_folder)
    release(spark)
    dims = {
        "dim_time": star.dim_time(scores),
        "dim_school": keyed(table(spark, sf, "supplier"), "s_suppkey", "schoolId"),
        "dim_major": keyed(table(spark, sf, "part"), "p_type", "majorId"),
        "dim_subject_group": star.dim_subject_group(groups),
        "dim_selection_method": star.dim_selection_method(methods),
        "dim_grading_scale": star.dim_grading_scale(scales),
    }
    facts = star.fact_benchmark(scores, dims)
    discard(spark, scores_folder)
    return facts


SUBJECTS = [(1, "Q"), (2, "D"), (3, "T")]
# The score text of measures.score_text, for the order of copies.
TEXT = """concat_ws(',', 'Q:' || l_linenumber, CASE WHEN l_returnflag = 'A' THEN ' D : ' || l_linenumber || '.5' END,
    CASE WHEN l_linestatus = 'F' THEN 'T:x' END, CASE WHEN l_linestatus = 'O' THEN 'T:' || CAST(l_quantity AS INTEGER) END,
    'no colon', 'Q:' || CAST(l_quantity AS INTEGER))"""
STUDENTS = f"""st AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey, year(l_shipdate) ORDER BY {TEXT} DESC) AS rn,
      lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS code, year(l_shipdate) AS year FROM lineitem),
    p AS (SELECT * FROM st WHERE rn = 1)"""


def students(spark, sf):
    """One raw row per line: a number that starts with the region's code, and a score text."""
    lines = wide_table(spark, sf, "lineitem")
    number = F.concat(F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), F.lit("-"), "l_orderkey", F.lit("-"), "l_linenumber")
    path = F.concat(F.lit("/bronze/"), F.year("l_shipdate"), F.lit("/scores.csv"))
    raw = lines.select(number.alias("SBD"), score_text().alias("DiemThi"), path.alias("path"))
    return silver.student_scores(raw, spark.createDataFrame(SUBJECTS, "subjectId int, subjectName string"))


def score_dims(spark, sf):
    codes = table(spark, sf, "supplier").select(F.substring(F.lpad(F.col("s_suppkey").cast("string"), 6, "0"), 1, 2).alias("regionId"))
    subjects = spark.createDataFrame(SUBJECTS, "subjectId int, subjectName string")
    groups = spark.createDataFrame(
        [(7, "G1", "Q-D"), (8, "G2", "q - T"), (9, "G3", "Q-Z")], "subjectGroupId int, subjectGroupName string, subjectCombination string"
    )
    dims = {
        "dim_region": keyed(codes, "regionId", "regionId"),
        "dim_subject": star.dim_subject(subjects),
        "dim_subject_group": star.dim_subject_group(groups),
        "dim_time": star.dim_time(table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"))),
    }
    return dims, subjects, groups


DIMS = """t AS (SELECT year, row_number() OVER (ORDER BY year) AS tk FROM (SELECT DISTINCT year(l_shipdate) AS year FROM lineitem)),
    g AS (SELECT code, row_number() OVER (ORDER BY code) AS rk FROM (SELECT DISTINCT substr(lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), 1, 2) AS code FROM supplier))"""


@query(
    "score_distribution",
    f"""WITH {STUDENTS}, {DIMS}, e AS (
          SELECT substr(code, 1, 2) AS code, year, 1 AS subject, CAST(l_quantity AS DECIMAL(18,6)) AS v FROM p
          UNION ALL SELECT substr(code, 1, 2), year, 2, CAST(l_linenumber + 0.5 AS DECIMAL(18,6)) FROM p WHERE l_returnflag = 'A'
          UNION ALL SELECT substr(code, 1, 2), year, 3, CAST(l_quantity AS DECIMAL(18,6)) FROM p WHERE l_linestatus = 'O'),
        h AS (SELECT code, year, subject, v - v % 0.2 AS bin, count(*) AS n FROM e GROUP BY ALL),
        f AS (SELECT rk, subject, tk, bin, n FROM h JOIN t USING (year) JOIN g USING (code))
      SELECT row_number() OVER (ORDER BY tk, rk, subject, bin) AS "SDBSKey", CAST(rk AS INTEGER) AS "regionKey",
             CASE subject WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS "subjectKey", CAST(tk AS INTEGER) AS "timeKey",
             CAST(CAST(bin AS DOUBLE) AS FLOAT) AS "scoreThreshold", CAST(n AS FLOAT) AS quantity FROM f""",
)
def score_distribution(spark, sf):
    dims, _, _ = score_dims(spark, sf)
    return star.fact_score_distribution_by_subject(students(spark, sf), dims)


@query(
    "group_score_distribution",
    f"""WITH {STUDENTS}, {DIMS}, e AS (
          SELECT substr(code, 1, 2) AS code, year, 1 AS grp, floor(l_quantity + l_linenumber + 0.5) AS bin FROM p WHERE l_returnflag = 'A'
          UNION ALL SELECT substr(code, 1, 2), year, 2, floor(l_quantity * 2) FROM p WHERE l_linestatus = 'O'),
        h AS (SELECT code, year, grp, bin, count(*) AS n FROM e GROUP BY ALL),
        f AS (SELECT rk, grp, tk, bin, n FROM h JOIN t USING (year) JOIN g USING (code))
      SELECT row_number() OVER (ORDER BY tk, rk, grp, bin) AS "SDBSGKey", CAST(rk AS INTEGER) AS "regionKey",
             CAST(grp AS INTEGER) AS "subjectGroupKey", CAST(tk AS INTEGER) AS "timeKey", CAST(bin AS FLOAT) AS "scoreRange",
             CAST(n AS FLOAT) AS quantity FROM f""",
)
def group_score_distribution(spark, sf):
    dims, subjects, groups = score_dims(spark, sf)
    return star.fact_score_distribution_by_subject_group(students(spark, sf), groups, subjects, dims)


@query(
    "article_merge",
    """WITH s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey % 1000 DESC, o_orderkey DESC) AS rn
                  FROM orders) WHERE rn = 1)
       SELECT coalesce(c_custkey, o_custkey) AS cust, CASE WHEN o_custkey IS NULL THEN c_name ELSE CAST(o_orderkey AS VARCHAR) END AS description,
              CASE WHEN o_custkey IS NULL THEN 0 ELSE o_orderkey % 1000 END AS likes,
              CASE WHEN c_custkey IS NULL THEN o_orderpriority ELSE 'old' END AS author
       FROM (SELECT * FROM customer WHERE c_acctbal > 0) FULL JOIN s ON c_custkey = o_custkey""",
)
def article_merge(spark, sf):
    """Customers with money are the known posts; orders are posts that come in again and again."""
    url = F.concat(F.lit("http://f/"), F.col("key").cast("string"))
    known = silver.facebook_posts(
        table(spark, sf, "customer").filter("c_acctbal > 0").select(
            F.col("c_custkey").alias("key"), F.lit("x").alias("ID"), F.col("c_name").alias("Description"), F.lit("old").alias("Author"),
            F.lit("Thứ Hai, 1 Tháng 1, 2024").alias("TimePublish"), F.lit("no").alias("Like"), F.lit(None).cast("string").alias("Share"), F.lit("1").alias("Comment"),
        ).withColumn("Url", url),
        RUN_TS,
    )
    day = F.col("o_orderdate")
    written = F.concat(F.lit("Thứ Hai, "), F.dayofmonth(day), F.lit(" Tháng "), F.month(day), F.lit(", "), F.year(day), F.lit(" lúc 0:00"))
    incoming = silver.facebook_posts(
        table(spark, sf, "orders").select(
            F.col("o_custkey").alias("key"), F.lpad(F.lit(10**12) - F.col("o_orderkey"), 14, "0").alias("ID"), F.col("o_orderkey").cast("string").alias("Description"),
            F.col("o_orderpriority").alias("Author"), written.alias("TimePublish"),
            F.pmod("o_orderkey", F.lit(1000)).cast("string").alias("Like"), F.lit("0").alias("Share"), F.lit("1").alias("Comment"),
        ).withColumn("Url", url),
        RUN_TS,
    )
    merged = silver.merge_facebook_posts(known, incoming)
    return merged.select(
        F.regexp_extract("url", r"(\d+)$", 1).cast("bigint").alias("cust"), "description", F.col("likeCount").cast("bigint").alias("likes"), "author"
    )


@query(
    "comment_sentiment",
    """WITH t AS (SELECT conv_id, turn, string_split_regex(lower(text), '\\s+') AS ws FROM conversations
                  WHERE conv_id * 1000 + turn NOT IN (SELECT doc_id FROM labels))
       SELECT conv_id * 1000 + turn AS "commentID", CAST(conv_id AS VARCHAR) AS "postID",
              CASE sign(len(list_filter(ws, lambda x: x IN ('the', 'la'))) - len(list_filter(ws, lambda x: x IN ('of', 'die'))))
                WHEN 1 THEN 'POS' WHEN -1 THEN 'NEG' ELSE 'NEU' END AS sentiment FROM t""",
)
def comment_sentiment(spark, sf):
    from lakemill.operators.scoring import lexicon_scorer

    comments = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("articleID"), (F.col("conv_id") * 1000 + F.col("turn")).alias("commentID"), F.col("text").alias("comment"),
        F.lit(None).cast("timestamp").alias("commentTime"), F.lit(0).alias("commentLike"), F.lit(1).alias("levelComment"),
        F.lit(0).alias("numberOfReply"), F.lit(RUN_TS).cast("timestamp").alias("created_at"),
    )
    done = table(spark, sf, "labels").select(F.col("doc_id").alias("commentID"))
    scored = social.comment_sentiment(comments, done, lexicon_scorer(["the", "la"], ["of", "die"]), RUN_TS)
    return scored.select("commentID", "postID", "sentiment")


@query(
    "name_reset",
    """SELECT n_regionkey AS region, count(*) AS total_records, CASE n_regionkey WHEN 2 THEN count(*) ELSE 0 END AS null_count,
              CASE n_regionkey WHEN 2 THEN 0 ELSE count(*) END AS not_null_count
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey""",
)
def name_reset(spark, sf):
    from lakemill.operators.aggregates import null_counts

    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("name"), F.lit(RUN_TS).cast("timestamp").alias("updated_at")
    )
    nations = table(spark, sf, "nation")
    cleared = changes.reset_by_type(rows, nations, "n_nationkey", "n_regionkey", 2, "name", F.lit(RUN_TS).cast("timestamp"))
    return null_counts(cleared.join(nations.select("n_nationkey", F.col("n_regionkey").alias("region")), "n_nationkey"), ["region"], "name")
