"""Parsers of small text formats. The strings are made from columns, so the SQL knows the truth."""

from pyspark.sql import functions as F

from lakemill.catalogue.measures import score_text
from lakemill.catalogue.registry import query, table, wide_table
from lakemill.functions import minitext, scalar


@query(
    "strip_suffix",
    "SELECT o_orderkey, o_orderpriority AS method FROM orders",
)
def strip_suffix(spark, sf):
    orders = table(spark, sf, "orders")
    suffix = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" năm "), F.year("o_orderdate"), F.lit(" đợt 2"))).otherwise("")
    return orders.select("o_orderkey", scalar.strip_year_suffix(F.concat("o_orderpriority", suffix)).alias("method"))


@query("strip_dot0", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS id FROM orders")
def strip_dot0(spark, sf):
    tail = F.when(F.col("o_orderstatus") == "O", ".0 ").otherwise("")
    text = F.concat(F.col("o_custkey").cast("string"), tail)
    return table(spark, sf, "orders").select("o_orderkey", scalar.strip_dot_zero(text).alias("id"))


@query(
    "extract_number",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(regexp_extract(props, '\\d+') AS DOUBLE) END AS number
       FROM events""",
)
def extract_number(spark, sf):
    text = F.when(F.col("event_type") == "view", "none here").otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", scalar.first_number(text).alias("number"))


@query(
    "magnitude",
    """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN p_size * 1000 + (p_partkey % 10) * 100 WHEN 'LARGE' THEN p_size * 1000000
              WHEN 'PROMO' THEN 0 WHEN 'MEDIUM' THEN 0 ELSE p_size END AS likes FROM part""",
)
def magnitude(spark, sf):
    kind, size = F.col("p_type"), F.col("p_size").cast("string")
    tenth = F.pmod("p_partkey", F.lit(10)).cast("string")
    text = (
        F.when(kind == "SMALL", F.concat(size, F.lit("."), tenth, F.lit("K")))
        .when(kind == "LARGE", F.concat(size, F.lit("M")))
        .when(kind == "PROMO", F.lit("many"))
        .when(kind != "MEDIUM", size)
    )
    return table(spark, sf, "part").select("p_partkey", scalar.magnitude(text).cast("bigint").alias("likes"))


def written_date():
    day, kind = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    plain = F.concat_ws("-", F.dayofmonth(day), F.month(day), F.year(day))
    worded = F.concat(F.lit("ngày "), F.dayofmonth(day), F.lit(" Tháng "), F.month(day), F.lit(", "), F.year(day))
    return (
        F.when(kind == "1", F.date_format(day, "dd-MM-yyyy"))
        .when(kind == "2", plain)
        .when(kind == "3", worded)
        .when(kind == "4", F.lit("2 ngày trước"))
        .otherwise("không rõ")
    )


@query(
    "parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderpriority[1] IN ('1', '2', '3') THEN date_trunc('day', o_orderdate) END AS published,
              CASE WHEN o_orderpriority[1] IN ('1', '2') THEN date_trunc('day', o_orderdate)
                   WHEN o_orderpriority[1] = '4' THEN TIMESTAMP '1970-01-01' END AS commented FROM orders""",
)
def parse_dates(spark, sf):
    text = written_date()
    return table(spark, sf, "orders").select(
        "o_orderkey", scalar.parse_date(text).alias("published"), scalar.parse_comment_time(text).alias("commented")
    )


@query(
    "parse_vn_date",
    """SELECT event_id, CASE event_type
           WHEN 'click' THEN date_trunc('minute', ts) WHEN 'view' THEN date_trunc('day', ts)
           WHEN 'error' THEN make_timestamp(2025, month(ts), day(ts), hour(ts), minute(ts), 0.0)
           WHEN 'signup' THEN make_timestamp(2025, month(ts), day(ts), 0, 0, 0.0) END AS at FROM events""",
)
def parse_vn_date(spark, sf):
    ts, kind = F.col("ts"), F.col("event_type")
    day = F.concat(F.lit("Thứ Hai, "), F.dayofmonth(ts), F.lit(" Tháng "), F.month(ts))
    year = F.concat(F.lit(", "), F.year(ts))
    clock = F.concat(F.lit(" lúc "), F.hour(ts), F.lit(":"), F.date_format(ts, "mm"))
    text = (
        F.when(kind == "click", F.concat(day, year, clock))
        .when(kind == "view", F.concat(day, year))
        .when(kind == "error", F.concat(day, clock))
        .when(kind == "signup", day)
        .otherwise("Hôm qua")
    )
    return table(spark, sf, "events").select("event_id", scalar.parse_long_date(text).alias("at"))


@query("path_year", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS year FROM orders")
def path_year(spark, sf):
    folder = F.when(F.col("o_orderstatus") == "P", "latest").otherwise(F.year("o_orderdate").cast("string"))
    path = F.concat(F.lit("s3a://bronze/scores/"), folder, F.lit("/part1.csv"))
    return table(spark, sf, "orders").select("o_orderkey", scalar.path_year(path).alias("year"))


@query(
    "split_explode",
    """SELECT p_partkey, w AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) WHERE w <> ''
       UNION ALL SELECT p_partkey, p_type FROM part""",
)
def split_explode(spark, sf):
    text = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(" - ")), F.lit("--  - "), F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", F.explode(minitext.split_trim(text, "-")).alias("word"))


@query(
    "parse_map",
    """SELECT l_orderkey, l_linenumber, l_partkey, floor(l_quantity) AS q,
              CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber + 0.5 AS DOUBLE) END AS d,
              CASE WHEN l_linestatus = 'O' THEN floor(l_quantity) END AS t FROM lineitem""",
)
def parse_map(spark, sf):
    rows = wide_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", minitext.parse_map(score_text()).alias("m"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[F.try_element_at("m", F.lit(k)).alias(k.lower()) for k in ("Q", "D", "T")],
    )


@query(
    "map_explode",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, floor(l_quantity) AS q FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, 1 AS subject, q AS score FROM s
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 2, CAST(l_linenumber + 0.5 AS DOUBLE) FROM s WHERE l_returnflag = 'A'""",
)
def map_explode(spark, sf):
    scores = minitext.parse_map_by_id(score_text(), {"Q": 1, "D": 2})
    # Exploded where it is made: as a column of its own it would be made again for the
    # emptiness filter that Spark puts under an explode.
    return wide_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.explode(scores).alias("subject", "score")
    )


@query(
    "label_split",
    """SELECT DISTINCT doc_id, unnest([lang, source, 'x']) AS label FROM documents""",
)
def label_split(spark, sf):
    text = F.concat_ws("|", "lang", F.concat(F.lit(" "), "source"), F.lit("None"), F.lit("  "), "lang", F.lit("x "))
    return table(spark, sf, "documents").select("doc_id", F.explode(minitext.split_labels(text)).alias("label"))


@query(
    "multi_hot",
    """WITH v AS (SELECT list(label ORDER BY label) AS labels FROM (SELECT DISTINCT unnest([lang, source]) AS label FROM documents))
       SELECT doc_id, array_to_string([CASE WHEN x = lang OR x = source THEN 1 ELSE 0 END FOR x IN labels], '') AS vector
       FROM documents, v""",
)
def multi_hot(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.array("lang", "source").alias("labels"))
    known = docs.withColumn("known", minitext.sorted_values(docs.select(F.explode("labels").alias("label")), "label"))
    vector = minitext.multi_hot("labels", F.col("known"))
    return known.select("doc_id", F.array_join(vector.cast("array<string>"), "").alias("vector"))


@query(
    "threshold_labels",
    """SELECT vec_id, coalesce(nullif(array_to_string(['T' || CAST(i AS VARCHAR) FOR e, i IN embedding IF e > 0], '|'), ''), 'None') AS topics,
              CAST(list_position(embedding, list_max(embedding)) AS VARCHAR) AS best FROM embeddings""",
)
def threshold_labels(spark, sf):
    vectors = table(spark, sf, "embeddings")
    size = vectors.select(F.max(F.size("embedding"))).first()[0]
    chances = vectors.select("vec_id", "embedding", minitext.sigmoid("embedding").alias("p"))
    return chances.select(
        "vec_id",
        minitext.labels_above("p", [f"T{i + 1}" for i in range(size)]).alias("topics"),
        minitext.best_label("embedding", [str(i + 1) for i in range(size)]).alias("best"),
    )
