"""Projection, filters, removal of copies."""

from pyspark.sql import functions as F

from lakemill.catalogue.registry import query, table, wide_table
from lakemill.functions.canonical import compose
from lakemill.functions.scalar import code_prefix, int_or, pad_code, yes_level
from lakemill.operators import clean


@query(
    "project_cast",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
              CAST(substr(c_name, 10) AS BIGINT) AS name_number,
              TRY_CAST(c_mktsegment AS INTEGER) AS segment_number, CAST(c_nationkey AS BIGINT) AS nation
       FROM customer""",
)
def project_cast(spark, sf):
    return clean.project_cast(
        table(spark, sf, "customer"),
        {
            "customer_id": ("c_custkey", "string"),
            "customer_name": ("c_name", "string"),
            "name_number": (F.substr("c_name", F.lit(10)), "bigint"),
            "segment_number": ("c_mktsegment", "int"),
            "nation": ("c_nationkey", "bigint"),
        },
    )


@query(
    "audit_cols",
    """SELECT c_custkey, c_name, TIMESTAMP '2025-01-01 00:00:00' AS created_at,
              TIMESTAMP '2025-01-01 00:00:00' AS updated_at FROM customer""",
)
def audit_cols(spark, sf):
    return clean.with_audit(table(spark, sf, "customer").select("c_custkey", "c_name"), "2025-01-01 00:00:00")


@query("positional_select", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, n_regionkey AS region FROM nation")
def positional_select(spark, sf):
    return clean.by_position(table(spark, sf, "nation"), {0: ("id", "string"), 1: ("name", "string"), 2: ("region", "int")})


@query(
    "align_schema",
    """SELECT event_id AS id, event_type AS kind, value AS amount, props, 0 AS likes FROM events
       UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice, NULL, 0 FROM orders""",
)
def align_schema(spark, sf):
    spec = {"id": ("bigint", None), "kind": ("string", None), "amount": ("double", 0.0), "props": ("string", None), "likes": ("int", 0)}
    rich = table(spark, sf, "events").withColumnsRenamed({"event_id": "id", "event_type": "kind", "value": "amount"})
    poor = table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "id", "o_orderpriority": "kind", "o_totalprice": "amount"})
    return clean.align(rich, spec).unionByName(clean.align(poor, spec))


@query(
    "string_basic",
    """SELECT n_nationkey, lower(n_name) AS low, upper(n_name) AS up, substr(n_name, 1, 6) AS head,
              lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name || '/' || n_regionkey AS joined,
              trim('  ' || n_name || ' ') AS trimmed FROM nation""",
)
def string_basic(spark, sf):
    name = F.col("n_name")
    return table(spark, sf, "nation").select(
        "n_nationkey",
        F.lower(name).alias("low"),
        F.upper(name).alias("up"),
        F.substring(name, 1, 6).alias("head"),
        pad_code("n_nationkey").alias("code"),
        F.concat(name, F.lit("/"), F.col("n_regionkey")).alias("joined"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
    )


@query(
    "code_prefix",
    """SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 8, '0') || year(o_orderdate) AS student_id,
              substr(lpad(CAST(o_custkey AS VARCHAR), 8, '0'), 1, 6) AS region_id FROM orders""",
)
def code_prefix_query(spark, sf):
    code = pad_code("o_custkey", 8)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(code, F.year("o_orderdate").cast("string")).alias("student_id"),
        code_prefix(code, 6).alias("region_id"),
    )


@query(
    "flag_level",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS level FROM orders",
)
def flag_level(spark, sf):
    flag = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No")
    return table(spark, sf, "orders").select("o_orderkey", yes_level(flag).alias("level"))


@query(
    "require_cols",
    """SELECT event_id, event_type, user_id FROM events
       WHERE event_type <> 'error' AND value <= 100""",
)
def require_cols(spark, sf):
    gaps = table(spark, sf, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("value") <= 100, F.col("user_id")).alias("user_id"),
    )
    return clean.require(gaps, ["event_type", "user_id"])


@query("non_blank", "SELECT doc_id, text FROM documents WHERE lang <> 'de'")
def non_blank(spark, sf):
    blanked = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") == "de", "   ").otherwise(F.col("text")).alias("text"))
    return clean.non_blank(blanked, ["text"])


@query("sentinel_null", "SELECT event_id, event_type AS kind FROM events WHERE event_type NOT IN ('error', 'view')")
def sentinel_null(spark, sf):
    kind = F.col("event_type")
    marked = table(spark, sf, "events").select(
        "event_id", F.when(kind == "error", "NaN").when(kind == "view", "None").otherwise(kind).alias("kind")
    )
    return clean.drop_sentinels(marked, "kind")


@query(
    "filter_in",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'
         AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def filter_in(spark, sf):
    day = F.col("o_orderdate")
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") == "F"))
        .filter((day >= F.lit("1997-01-01").cast("timestamp")) & (day < F.lit("1999-01-01").cast("timestamp")))
        .select("o_orderkey", "o_totalprice")
    )


@query(
    "int_default",
    "SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 0 ELSE p_size END AS size FROM part",
)
def int_default(spark, sf):
    text = F.when(F.col("p_type") == "SMALL", "n/a").otherwise(F.col("p_size").cast("string"))
    return table(spark, sf, "part").select("p_partkey", int_or(text).alias("size"))


@query("dedup_all", "SELECT DISTINCT p_name, p_type, p_brand FROM part")
def dedup_all(spark, sf):
    return clean.dedup_all(table(spark, sf, "part").select("p_name", "p_type", "p_brand"))


@query(
    "dedup_key",
    """SELECT doc_id, lang, source FROM (
         SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def dedup_key(spark, sf):
    # The digest stands for the text, so the shuffle carries no texts.
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("digest"))
    return clean.dedup_by(docs, ["digest"], ["doc_id"]).drop("digest")


@query(
    "dedup_ci",
    """SELECT min(name) AS name FROM (
         SELECT CASE WHEN p_type = 'SMALL' THEN upper(p_name) ELSE p_name END AS name FROM part) GROUP BY lower(name)""",
)
def dedup_ci(spark, sf):
    name = F.when(F.col("p_type") == "SMALL", F.upper("p_name")).otherwise(F.col("p_name"))
    return clean.dedup_ignore_case(table(spark, sf, "part").select(name.alias("name")), "name")


@query("composed_text", "SELECT doc_id, sha256(nfc_normalize(text)) AS composed, text <> nfc_normalize(replace(text, 'e', 'e' || chr(769))) AS changed FROM documents")
def composed_text(spark, sf):
    """Texts whose accents are written as marks, composed again; and texts in which every e gets one."""
    docs = wide_table(spark, sf, "documents").select("doc_id", "text")
    marked = F.col("text")
    for letter, base, mark in (("é", "e", "\u0301"), ("è", "e", "\u0300"), ("ñ", "n", "\u0303"), ("ó", "o", "\u0301"), ("ê", "e", "\u0302")):
        marked = F.replace(marked, F.lit(letter), F.lit(base + mark))
    accented = compose(F.replace("text", F.lit("e"), F.lit("e\u0301")))
    return docs.select("doc_id", F.sha2(compose(marked), 256).alias("composed"), (F.col("text") != accented).alias("changed"))
