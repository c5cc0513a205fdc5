"""Row-level changes: customers as the table, orders as the batch."""

from pyspark.sql import functions as F

from lakemill.catalogue.registry import query, table
from lakemill.operators import changes, keys

TARGET = """t AS (SELECT c_custkey AS cust, nullif(c_mktsegment, 'HOUSEHOLD') AS method, c_acctbal AS score,
                  TIMESTAMP '2024-01-01' AS updated_at FROM customer)"""
SOURCE = """s AS (SELECT o_custkey AS cust, CASE o_orderstatus WHEN 'F' THEN 'BUILDING' WHEN 'O' THEN 'MACHINERY' END AS method,
                  max(o_totalprice) AS score, TIMESTAMP '2025-01-01' AS updated_at FROM orders GROUP BY 1, 2)"""
MATCH = "t.cust = s.cust AND t.method IS NOT DISTINCT FROM s.method"


def target(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cust"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("method"),
        F.col("c_acctbal").alias("score"),
        F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
    )


def batch(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cust"),
        F.when(status == "F", "BUILDING").when(status == "O", "MACHINERY").alias("method"),
        F.col("o_totalprice").alias("score"),
        F.lit("2025-01-01").cast("timestamp").alias("updated_at"),
        "o_orderkey",
    )


def latest(spark, sf):
    return changes.dedup_by(batch(spark, sf), ["cust", "method"], ["-score", "o_orderkey"]).drop("o_orderkey")


@query(
    "upsert_full",
    f"""WITH {TARGET}, {SOURCE}
        SELECT coalesce(t.cust, s.cust) AS cust, CASE WHEN t.cust IS NULL THEN s.method ELSE t.method END AS method,
               coalesce(s.score, t.score) AS score, coalesce(s.updated_at, t.updated_at) AS updated_at
        FROM t FULL JOIN s ON {MATCH}""",
)
def upsert_full(spark, sf):
    return changes.upsert(
        target(spark, sf), batch(spark, sf), ["cust", "method"], ["score", "updated_at"], order=["-score", "o_orderkey"]
    )


@query(
    "upsert_hash_id",
    f"""WITH {TARGET}, {SOURCE}, n AS (
          SELECT 1 FROM t FULL JOIN s ON {MATCH} WHERE t.cust IS NULL)
        SELECT (SELECT count(*) FROM t) AS n_kept, (SELECT count(*) FROM n) AS n_new, (SELECT count(*) FROM n) AS n_ids""",
)
def upsert_hash_id(spark, sf):
    old = target(spark, sf).withColumn("id", F.lit(None).cast("bigint"))
    id_of = {"id": keys.hash_key(["cust", "method"], {"method": "-1"})}
    merged = changes.upsert(old, latest(spark, sf), ["cust", "method"], ["score", "updated_at"], inserts=id_of)
    per_id = merged.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    is_new = F.col("id").isNotNull()
    return per_id.agg(
        F.sum(F.when(~is_new, F.col("n"))).alias("n_kept"),
        F.sum(F.when(is_new, F.col("n"))).alias("n_new"),
        F.count("id").alias("n_ids"),
    )


@query(
    "merge_update_only",
    f"""WITH {TARGET}, {SOURCE}
        SELECT t.cust, t.method, CASE WHEN s.cust IS NULL THEN t.score ELSE s.score END AS score,
               CASE WHEN s.cust IS NULL THEN t.updated_at ELSE s.updated_at END AS updated_at FROM t LEFT JOIN s ON {MATCH}""",
)
def merge_update_only(spark, sf):
    return changes.merge_update(target(spark, sf), latest(spark, sf), ["cust", "method"], ["score", "updated_at"])


@query(
    "replace_by_key",
    f"""WITH {TARGET}, one AS (
          SELECT o_custkey AS cust, CASE o_orderstatus WHEN 'F' THEN 'BUILDING' WHEN 'O' THEN 'MACHINERY' END AS method,
                 o_totalprice AS score, TIMESTAMP '2025-01-01' AS updated_at,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
        SELECT * FROM t WHERE cust NOT IN (SELECT cust FROM one)
        UNION ALL SELECT cust, method, score, updated_at FROM one WHERE rn = 1""",
)
def replace_by_key(spark, sf):
    old = target(spark, sf).withColumn("o_orderkey", F.lit(None).cast("bigint"))
    return changes.replace_by_key(old, batch(spark, sf), ["cust"], ["-score", "o_orderkey"]).drop("o_orderkey")


@query(
    "reset_column",
    """SELECT c_custkey, CASE WHEN n_regionkey = 1 THEN NULL ELSE c_mktsegment END AS segment,
              CASE WHEN n_regionkey = 1 THEN TIMESTAMP '2025-01-01' ELSE TIMESTAMP '2024-01-01' END AS updated_at
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def reset_column(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    stamp = F.lit("2025-01-01").cast("timestamp")
    nations = table(spark, sf, "nation")
    return changes.reset_by_type(rows, nations, "n_nationkey", "n_regionkey", 1, "segment", stamp).drop("n_nationkey")


@query(
    "reset_all",
    "SELECT c_custkey, CAST(NULL AS VARCHAR) AS segment, TIMESTAMP '2025-01-01' AS updated_at FROM customer",
)
def reset_all(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.lit("2024-01-01").cast("timestamp").alias("updated_at")
    )
    return changes.reset_column(rows, "segment", F.lit("2025-01-01").cast("timestamp"))
