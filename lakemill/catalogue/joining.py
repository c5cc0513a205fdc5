"""Lookups, star resolution, new-rows-only selection."""

from pyspark.sql import functions as F

from lakemill.catalogue.registry import query, table
from lakemill.operators import changes, joins, keys
from lakemill.operators.clean import dedup_all


@query(
    "left_lookup",
    """SELECT o_orderkey, c_mktsegment FROM orders
       LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus <> 'P'""",
)
def left_lookup(spark, sf):
    orders = table(spark, sf, "orders")
    code = F.concat(F.lit(" Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(" năm 2024 đợt 1"))
    raw = orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", code).alias("raw"))
    cleaned = F.trim(F.regexp_replace("raw", r"\s*năm\s+\d{4}.*$", ""))
    return joins.left_lookup(raw, table(spark, sf, "customer"), cleaned, F.trim("c_name"), ["c_mktsegment"]).drop("raw")


def star(spark, sf):
    return joins.star_resolve(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        [
            joins.Dim(table(spark, sf, "part"), "l_partkey", "p_partkey", ("p_type",)),
            joins.Dim(table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", ("s_nationkey",)),
            joins.Dim(table(spark, sf, "orders"), "l_orderkey", "o_orderkey", ("o_custkey", "o_orderdate")),
            joins.Dim(table(spark, sf, "nation"), "s_nationkey", "n_nationkey", ("n_regionkey",)),
        ],
    )


@query(
    "star_resolve",
    """SELECT l_orderkey, l_linenumber, p_type, s_nationkey, o_custkey, n_regionkey FROM lineitem
       LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def star_resolve(spark, sf):
    return star(spark, sf).select("l_orderkey", "l_linenumber", "p_type", "s_nationkey", "o_custkey", "n_regionkey")


@query(
    "unresolved_keys",
    """SELECT 'c_mktsegment' AS key, count(*) FILTER (WHERE c_custkey IS NULL) AS n_unresolved
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
       UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_custkey IS NULL)
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""",
)
def unresolved_keys(spark, sf):
    dim = table(spark, sf, "customer").filter("c_acctbal > 0")
    fact = joins.star_resolve(table(spark, sf, "orders"), [joins.Dim(dim, "o_custkey", "c_custkey", ("c_mktsegment", "c_nationkey"))])
    return joins.unresolved(fact, ["c_mktsegment", "c_nationkey"])


@query(
    "skew_lookup",
    """SELECT event_id, user_id, c_mktsegment FROM events LEFT JOIN customer ON c_custkey = user_id""",
)
def skew_lookup(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    dim = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return joins.skew_lookup(events, dim, "user_id", ["c_mktsegment"], hot_rows=75)


@query(
    "bcast_inner",
    """WITH d AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS type_id FROM (SELECT DISTINCT p_type FROM part))
       SELECT p_partkey, CAST(type_id AS BIGINT) AS type_id FROM part JOIN d USING (p_type)""",
)
def bcast_inner(spark, sf):
    part = table(spark, sf, "part")
    types = keys.surrogate_key(part.select("p_type").distinct(), "type_id", ["p_type"])
    messy = part.select("p_partkey", F.concat(F.lit(" "), F.lower("p_type"), F.lit("  ")).alias("p_type"))
    return joins.dictionary_join(messy, types, "p_type", ["type_id"]).select("p_partkey", "type_id")


@query(
    "join_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE p_type = 'ECONOMY'""",
)
def join_filter(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.filter(F.col("p_type") == "ECONOMY").select("l_orderkey", "l_linenumber", "l_quantity", "p_brand")


@query(
    "join_fanout",
    """SELECT p_partkey, d.p_type AS type FROM part JOIN (SELECT DISTINCT p_name, p_type FROM part) d USING (p_name)""",
)
def join_fanout(spark, sf):
    part = table(spark, sf, "part")
    pairs = dedup_all(part.select(F.col("p_name").alias("name"), F.col("p_type").alias("type")))
    return joins.left_lookup(part.select("p_partkey", "p_name"), pairs, "p_name", "name", ["type"]).select("p_partkey", "type")


@query(
    "repeated_keys",
    "SELECT p_name, count(*) AS n_rows FROM part GROUP BY p_name HAVING count(*) > 1",
)
def repeated_keys(spark, sf):
    return joins.repeated_keys(table(spark, sf, "part"), ["p_name"])


@query(
    "left_count_zero",
    """SELECT n_nationkey, n_name, count(s_suppkey) AS n_suppliers FROM nation
       LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 8000) ON s_nationkey = n_nationkey GROUP BY ALL""",
)
def left_count_zero(spark, sf):
    rich = table(spark, sf, "supplier").filter("s_acctbal > 8000").withColumnRenamed("s_nationkey", "n_nationkey")
    return joins.count_children(table(spark, sf, "nation"), rich, "n_nationkey", ["n_nationkey", "n_name"], "n_suppliers")


@query(
    "anti_new",
    "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def anti_new(spark, sf):
    return joins.new_rows(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


@query(
    "batch_limit",
    """SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
       ORDER BY doc_id LIMIT 200""",
)
def batch_limit(spark, sf):
    return joins.next_batch(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id", 200)


@query(
    "insert_absent",
    "SELECT c_custkey AS cust, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def insert_absent(spark, sf):
    target = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("cust"))
    source = table(spark, sf, "customer").select(F.col("c_custkey").alias("cust"), "c_name")
    return changes.insert_absent(target, source, ["cust"])
