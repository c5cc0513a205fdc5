"""Round trips through files and tables. Each run writes to a fresh folder of the shared one."""

import os

from pyspark.sql import functions as F

from lakemill.catalogue.registry import query, table
from lakemill.operators import clean, quality
from lakemill.plans import feeds
from lakemill.session import scratch_path
from lakemill.sinks.tables import Lake, compact, with_day, write
from lakemill.sources import csv_files
from lakemill.streaming import ledger

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def lake(spark, label, schemas=None, buckets=None):
    path = scratch_path(spark, label)
    return Lake(spark, os.path.basename(path).replace("-", "_"), path, schemas, buckets)


@query("dq_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def dq_counts(spark, sf):
    return quality.row_counts({t: table(spark, sf, t) for t in TABLES})


ORDERS = {
    "o_orderkey": ("o_orderkey", "bigint"), "o_custkey": ("o_custkey", "bigint"), "o_orderstatus": ("o_orderstatus", "string"),
    "o_totalprice": ("o_totalprice", "double"), "o_orderdate": ("o_orderdate", "timestamp"), "o_orderpriority": ("o_orderpriority", "string"),
}


@query("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    source = table(spark, sf, "customer")
    source.write.option("header", True).csv(path)
    text = csv_files.read_csv(spark, path)
    return clean.project_cast(text, {f.name: (f.name, f.dataType.simpleString()) for f in source.schema.fields})


@query("csv_inferred", "SELECT c_custkey, c_acctbal, c_name FROM customer")
def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    read = csv_files.read_csv(spark, path, infer=True)
    return read.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_acctbal", "c_name")


@query("csv_malformed", "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, 'a, b' AS note FROM events WHERE event_type <> 'error'")
def csv_malformed(spark, sf):
    path = scratch_path(spark, "csv")
    extra = F.when(F.col("event_type") == "error", ",one,too,many").otherwise("")
    line = F.concat("event_id", F.lit(","), "event_type", F.lit(',"a, b",'), "user_id", F.lit(","), F.lit("x"), extra)
    raw = table(spark, sf, "events").select(line.alias("id,kind,note,user,end"))
    raw.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)
    return csv_files.read_exact(spark, path, ["id", "kind", "note", "user", "end"]).select("id", "kind", "note")


@query("union_tagged", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def union_tagged(spark, sf):
    path = scratch_path(spark, "csv")
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    orders.select("o_orderkey", "o_totalprice", "y").write.partitionBy("y").option("header", True).csv(path)
    years = [r["y"] for r in orders.select("y").distinct().orderBy("y").collect()]
    sources = {y: os.path.join(path, f"y={y}") for y in years} | {1900: os.path.join(path, "y=1900")}
    tagged = csv_files.read_tagged(spark, sources, "year")
    return clean.project_cast(tagged, {"o_orderkey": ("o_orderkey", "bigint"), "o_totalprice": ("o_totalprice", "double"), "year": ("year", "int")})


def write_yearly_csv(spark, sf, path):
    """Orders as CSV files in year folders, with one column fewer in one status' files."""
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    full = orders.filter("o_orderstatus <> 'P'")
    full.write.partitionBy("y").option("header", True).csv(os.path.join(path, "full"))
    short = orders.filter("o_orderstatus = 'P'").drop("o_custkey")
    short.select("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "y").write.partitionBy("y").option(
        "header", True
    ).csv(os.path.join(path, "short"))
    keyless = orders.select(F.col("o_orderkey").alias("other"), "o_orderstatus")
    keyless.write.option("header", True).csv(os.path.join(path, "keyless"))


@query(
    "ledger_ingest",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice,
              o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def ledger_ingest(spark, sf):
    path = scratch_path(spark, "ingest")
    write_yearly_csv(spark, sf, os.path.join(path, "in"))
    target, log = os.path.join(path, "rows"), os.path.join(path, "ledger")

    def transform(df):
        year = F.regexp_extract("source_file", r"/y=(\d{4})/", 1).try_cast("int")
        return clean.project_cast(clean.align(df, {n: ("string", None) for n in [*ORDERS, "source_file"]}), {**ORDERS, "year": (year, "int")})

    for _ in range(2):
        ledger.load_new_files(spark, os.path.join(path, "in"), target, log, transform, "o_orderkey", "2025-01-01 00:00:00", files_per_batch=40)
    return spark.read.parquet(target).drop("ingest_run")


@query("stream_ingest", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def stream_ingest(spark, sf):
    path = scratch_path(spark, "stream")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    # Two folders whose files have their columns in opposite orders.
    orders.filter("o_orderstatus = 'F'").write.option("header", True).csv(os.path.join(path, "in/one"))
    other = orders.filter("o_orderstatus <> 'F'").select(*reversed(orders.columns))
    other.write.option("header", True).csv(os.path.join(path, "in/two"))
    for _ in range(2):
        ledger.stream_new_files(
            spark, os.path.join(path, "in"), os.path.join(path, "rows"), os.path.join(path, "checkpoint"),
            orders.schema, lambda batch: batch.drop("source_file"), files_per_batch=4,
        )
    return spark.read.parquet(os.path.join(path, "rows")).drop("ingest_run")


@query("replace_table", "SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM customer")
def replace_table(spark, sf):
    home = lake(spark, "replace")
    home.replace("customer", table(spark, sf, "customer"))
    doubled = home.read("customer").select("c_custkey", "c_name", (F.col("c_acctbal") * 2).alias("c_acctbal"))
    return home.replace("customer", doubled)


@query("append_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_table(spark, sf):
    home = lake(spark, "append")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status in ("F", "O", "P"):
        home.append("orders", orders.filter(F.col("o_orderstatus") == status))
    return home.read("orders")


@query("upsert_table", "SELECT c_custkey, c_name, CASE WHEN c_acctbal > 5000 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer")
def upsert_table(spark, sf):
    home = lake(spark, "upsert")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    home.upsert("customer", rows.filter("c_acctbal > 0"), ["c_custkey"], ["c_acctbal"])
    capped = rows.withColumn("c_acctbal", F.when(F.col("c_acctbal") > 5000, 0.0).otherwise(F.col("c_acctbal")))
    return home.upsert("customer", capped, ["c_custkey"], ["c_acctbal"])


@query(
    "update_partitioned",
    """SELECT o_orderkey, o_orderstatus, CASE o_orderpriority WHEN '1-URGENT' THEN 2 * o_totalprice ELSE o_totalprice END AS o_totalprice
       FROM orders""",
)
def update_partitioned(spark, sf):
    """The batch does not say in which partition its rows lie."""
    home = lake(spark, "update")
    orders = table(spark, sf, "orders")
    home.replace("orders", orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_orderstatus"])
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", (2 * F.col("o_totalprice")).alias("o_totalprice"))
    home.update("orders", urgent, ["o_orderkey"], ["o_totalprice"])
    return home.read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("partitioned_write", "SELECT event_id, event_type, CAST(ts AS DATE) AS ts_day, value FROM events")
def partitioned_write(spark, sf):
    path = scratch_path(spark, "days")
    events = with_day(table(spark, sf, "events"), "ts").select("event_id", "event_type", "ts_day", "value")
    write(events, path, partition_by=["ts_day"])
    return spark.read.parquet(path)


@query("file_compaction", "SELECT count(*) AS n_rows, 0 AS n_oversize FROM lineitem")
def file_compaction(spark, sf):
    path = scratch_path(spark, "files")
    lines = table(spark, sf, "lineitem")
    write(compact(lines, lines.count(), 10_000), path, rows_per_file=12_000)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 12_000).alias("n_oversize"))


@query("list_files", "SELECT count(DISTINCT o_orderstatus) AS n_folders, count(*) AS n_rows FROM orders")
def list_files(spark, sf):
    path = scratch_path(spark, "listing")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    orders.write.partitionBy("status").option("header", True).csv(path)
    files = csv_files.list_files(spark, path).select(F.regexp_extract("path", r"status=(\w)/", 1).alias("folder")).distinct()
    rows = csv_files.read_csv(spark, path).agg(F.count(F.lit(1)).alias("n_rows"))
    return files.agg(F.count(F.lit(1)).alias("n_folders")).unionByName(rows, allowMissingColumns=True).agg(
        F.max("n_folders").alias("n_folders"), F.max("n_rows").alias("n_rows")
    )


@query(
    "ddl_registry",
    """SELECT 'customer' AS table_name, 5 AS n_columns, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'nation', 3, count(*) FROM nation UNION ALL SELECT 'orders', 6, count(*) FROM orders""",
)
def ddl_registry(spark, sf):
    sources = {t: table(spark, sf, t) for t in ("customer", "nation", "orders")}
    home = lake(spark, "ddl", {t: (df.schema, []) for t, df in sources.items()})
    home.create_all()
    for name, df in sources.items():
        home.append(name, df)
    counts = quality.row_counts({t: home.read(t) for t in home.list_tables()})
    widths = {t: len(home.read(t).columns) for t in home.list_tables()}
    table_of = F.create_map(*[F.lit(x) for pair in widths.items() for x in pair])
    return counts.withColumn("n_columns", F.try_element_at(table_of, "table_name"))


@query(
    "time_range",
    """SELECT event_id, event_type, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-05 06:30:00' AND ts < TIMESTAMP '2024-01-19 12:00:00'""",
)
def time_range(spark, sf):
    """Events stored by day, read for a range of times: other days' files are not opened."""
    home = lake(spark, "range")
    home.replace("events", with_day(table(spark, sf, "events"), "ts"), partition_by=["ts_day"])
    return home.read_between("events", "ts", "2024-01-05 06:30:00", "2024-01-19 12:00:00").select("event_id", "event_type", "value")


@query(
    "bucketed_replace",
    """WITH one AS (SELECT o_custkey AS cust, o_totalprice AS amount,
                    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
       SELECT c_custkey AS cust, c_acctbal AS amount FROM customer WHERE c_custkey NOT IN (SELECT cust FROM one)
       UNION ALL SELECT cust, amount FROM one WHERE rn = 1""",
)
def bucketed_replace(spark, sf):
    """Each customer's row gives way to its largest order, in a table that lies in buckets by customer."""
    home = lake(spark, "buckets", buckets={"accounts": (8, ["cust"])})
    home.replace("accounts", table(spark, sf, "customer").select(F.col("c_custkey").alias("cust"), F.col("c_acctbal").alias("amount"), F.lit(None).cast("bigint").alias("o_orderkey")))
    batch = table(spark, sf, "orders").select(F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("amount"), "o_orderkey")
    return home.replace_by_key("accounts", batch, ["cust"], ["-amount", "o_orderkey"]).select("cust", "amount")


@query(
    "followed_counts",
    """SELECT CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE 'BUYER' END AS segment, count(*) AS quantity
       FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey GROUP BY 1""",
)
def followed_counts(spark, sf):
    """Customers per segment, kept up from two loads' changes: all customers, then those who ordered under another segment."""
    home = lake(spark, "followed")
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    buyers = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("BUYER").alias("segment")).distinct()
    log, counts = feeds.feed(home, "customers"), feeds.Runs(home, "_counts", "by_segment")
    for run, batch in (("1", customers), ("2", buyers.join(customers, "c_custkey", "left_semi"))):
        home.replace_by_key("customers", feeds.put_changes(home, "customers", run, batch, ["c_custkey"], []), ["c_custkey"], ["c_custkey"])
        found = feeds.follow(counts, log, lambda rows: rows.groupBy("segment").agg(F.sum(feeds.SIGN).alias("quantity")), ["segment"])
    return found
