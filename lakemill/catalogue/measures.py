"""Aggregates, histograms, keys and window measures."""

from pyspark.sql import functions as F

from lakemill.catalogue.joining import star
from lakemill.catalogue.registry import mean2, mean6, query, table, wide_table
from lakemill.functions.minitext import parse_map, split_labels
from lakemill.operators import aggregates as agg
from lakemill.operators import joins, keys, windows
from lakemill.session import cut

DEC = "CAST({} AS DECIMAL(18,2))"


@query("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(spark, sf):
    return agg.group_count(table(spark, sf, "events"), ["event_type"])


@query(
    "group_stats",
    f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {mean6("sum(CAST(l_extendedprice AS DECIMAL(18,2)))", "count(*)")} AS mean,
               min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1, 2""",
)
def group_stats(spark, sf):
    return agg.group_stats(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


@query(
    "avg_distinct",
    f"""SELECT l_suppkey, l_returnflag, {mean2("sum(v)", "count(*)")} AS score
        FROM (SELECT DISTINCT l_suppkey, l_returnflag, CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem) GROUP BY 1, 2""",
)
def avg_distinct(spark, sf):
    return agg.mean_of_distinct(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_quantity", "score")


@query(
    "count_distinct",
    "SELECT event_type, count(*) AS total_records, count(DISTINCT user_id) AS users FROM events GROUP BY event_type",
)
def count_distinct(spark, sf):
    return agg.count_and_distinct(table(spark, sf, "events"), ["event_type"], "user_id", "total_records", "users")


@query(
    "cond_sum",
    """SELECT event_type, count(*) AS total_records, count(*) FILTER (WHERE value > 20) AS null_count,
              count(*) FILTER (WHERE value <= 20) AS not_null_count FROM events GROUP BY event_type""",
)
def cond_sum(spark, sf):
    events = table(spark, sf, "events").select("event_type", F.when(F.col("value") <= 20, F.col("value")).alias("kept"))
    return agg.null_counts(events, ["event_type"], "kept")


@query(
    "coverage",
    """SELECT count(*) AS total, count(l.doc_id) AS mapped, count(*) - count(l.doc_id) AS unmapped,
              round(count(l.doc_id) * 100.0 / count(*), 4) AS pct_mapped
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def coverage(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return agg.coverage(docs.join(table(spark, sf, "labels"), "doc_id", "left"), "quality")


def score_text():
    """A ``k:v`` list made of one row's own columns, with bad values and copies in it."""
    number = F.col("l_linenumber").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    return F.concat_ws(
        ",",
        F.concat(F.lit("Q:"), number),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit(" D : "), number, F.lit(".5"))),
        F.when(F.col("l_linestatus") == "F", F.lit("T:x")),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("T:"), quantity)),
        F.lit("no colon"),
        F.concat(F.lit("Q:"), quantity),
    )


MAP_SIZE = "1 + CAST(l_returnflag = 'A' AS INTEGER) + CAST(l_linestatus = 'O' AS INTEGER)"


@query("map_size", f"SELECT {MAP_SIZE} AS n_entries, count(*) AS n FROM lineitem GROUP BY 1")
def map_size(spark, sf):
    return agg.map_size_distribution(wide_table(spark, sf, "lineitem").select(parse_map(score_text()).alias("m")), "m")


@query(
    "hist_02",
    """SELECT event_type, CAST(v - v % 0.2 AS DOUBLE) AS bin, count(*) AS quantity
       FROM (SELECT event_type, CAST(value AS DECIMAL(18,6)) AS v FROM events) GROUP BY 1, 2""",
)
def hist_02(spark, sf):
    return agg.histogram(table(spark, sf, "events"), "value", "0.2", ["event_type"], "bin", "quantity")


@query(
    "hist_1",
    """SELECT event_type, CAST(ts AS DATE) AS day, floor(value) AS bin, count(*) AS quantity FROM events GROUP BY 1, 2, 3""",
)
def hist_1(spark, sf):
    events = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    return agg.histogram(events, "value", "1", ["event_type", "day"], "bin", "quantity")


@query(
    "hist_star",
    """WITH t AS (SELECT y, row_number() OVER (ORDER BY y) AS k FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)),
         h AS (SELECT l_suppkey, year(l_shipdate) AS y, l_returnflag, floor(l_quantity / 5) * 5 AS bin, count(*) AS n
               FROM lineitem GROUP BY ALL),
         r AS (SELECT s_nationkey AS nation, CAST(t.k AS INTEGER) AS time_key, l_suppkey AS supplier, l_returnflag AS flag,
                      CAST(bin AS DOUBLE) AS bin, n AS quantity
               FROM h LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN t ON t.y = h.y)
       SELECT row_number() OVER (ORDER BY time_key NULLS FIRST, nation, supplier, flag, bin) AS fact_key, * FROM r""",
)
def hist_star(spark, sf):
    items = table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year"), "l_returnflag", "l_quantity")
    counted = agg.histogram(items, "l_quantity", "5", ["l_suppkey", "year", "l_returnflag"], "bin", "quantity")
    times = keys.year_dimension(table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")), "year")
    fact = joins.star_resolve(
        counted,
        [
            joins.Dim(table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", ("s_nationkey",)),
            joins.Dim(times, "year", "year", ("timeKey",)),
        ],
    ).select(
        F.col("s_nationkey").alias("nation"), F.col("timeKey").alias("time_key"), F.col("l_suppkey").alias("supplier"),
        F.col("l_returnflag").alias("flag"), "bin", "quantity",
    )
    return keys.surrogate_key(fact, "fact_key", ["time_key", "nation", "supplier", "flag", "bin"])


GROUPS = [("G1", "click-view"), ("G2", "click - purchase - signup"), ("G3", "error"), ("G4", "click-refund")]


@query(
    "complete_group_sum",
    """WITH m(grp, member, need) AS (VALUES ('G1','click',2),('G1','view',2),('G2','click',3),('G2','purchase',3),
            ('G2','signup',3),('G3','error',1),('G4','click',2),('G4','refund',2)),
         f AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY ALL)
       SELECT user_id, day, grp, CAST(sum(v) AS DOUBLE) AS total FROM f JOIN m ON member = event_type
       GROUP BY user_id, day, grp HAVING count(*) = max(need)""",
)
def complete_group_sum(spark, sf):
    members = agg.group_members(spark.createDataFrame(GROUPS, "grp string, combination string"), "grp", "combination")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return agg.complete_sum(events, ["user_id", "day"], "event_type", "value", members, "grp", "total")


@query(
    "complete_map_sum",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS a, l_linestatus AS o,
              floor(l_quantity) AS q, l_linenumber + 0.5 AS d FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, 1 AS grp, CAST(q + d AS DOUBLE) AS total FROM s WHERE a = 'A'
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 2, CAST(q + d + q AS DOUBLE) FROM s WHERE a = 'A' AND o = 'O'
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 3, CAST(q AS DOUBLE) FROM s""",
)
def complete_map_sum(spark, sf):
    groups = spark.createDataFrame([(1, "Q-D"), (2, "Q-D-T"), (3, "Q"), (4, "Q-Z")], "grp int, combination string")
    rows = wide_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", parse_map(score_text()).alias("scores"))
    members = agg.group_members(groups, "grp", "combination")
    return agg.complete_sum_of_maps(rows, ["l_orderkey", "l_linenumber", "l_partkey"], "scores", members, "grp", "total")


@query(
    "surrogate_key",
    "SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS supplier_key FROM supplier",
)
def surrogate_key(spark, sf):
    return keys.surrogate_key(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), "supplier_key", ["-s_acctbal", "s_suppkey"]).drop("s_acctbal")


LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(
    "fact_key",
    f"""SELECT l_shipdate, l_suppkey, l_partkey, l_orderkey, l_linenumber, l_extendedprice,
               row_number() OVER (ORDER BY l_shipdate, l_suppkey, l_partkey, {", ".join(LINE)}) AS fact_key FROM lineitem""",
)
def fact_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    numbered = keys.surrogate_key(lines, "fact_key", ["l_shipdate", "l_suppkey", "l_partkey", *LINE])
    return numbered.select("l_shipdate", "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", "fact_key")


@query(
    "alloc_ids",
    """SELECT s_name AS name, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS c_custkey
       FROM supplier""",
)
def alloc_ids(spark, sf):
    fresh = table(spark, sf, "supplier").select(F.col("s_name").alias("name"))
    return keys.continue_ids(fresh, table(spark, sf, "customer"), "c_custkey", ["name"])


@query(
    "hash_key",
    """SELECT count(*) AS n_rows, count(DISTINCT (l_suppkey, coalesce(nullif(l_returnflag, 'N'), '-1'), l_shipdate)) AS n_ids
       FROM lineitem""",
)
def hash_key(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"), "l_shipdate")
    ids = lines.select(keys.hash_key(["l_suppkey", "flag", "l_shipdate"], {"flag": "-1"}).alias("id"))
    per_id = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.sum("n").alias("n_rows"), F.count("id").alias("n_ids"))


@query(
    "dim_time",
    """SELECT CAST(row_number() OVER (ORDER BY y) AS INTEGER) AS "timeKey", 1 AS day, 1 AS month, CAST(y AS INTEGER) AS year
       FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""",
)
def dim_time(spark, sf):
    return keys.year_dimension(table(spark, sf, "orders").select(F.year("o_orderdate").alias("y")), "y")


@query("remap_key", "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def remap_key(spark, sf):
    return keys.remap_key(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"P": "O"})


def yearly_scores(spark, sf, extra=()):
    """Mean price per supplier, part type and order year: the shape of the score fact."""
    rows = star(spark, sf).withColumn("year", F.year("o_orderdate"))
    by = ["l_suppkey", "p_type", "year", *extra]
    return rows.groupBy(*by).agg(F.round(F.avg(F.col("l_extendedprice").cast(agg.MONEY)), 2).cast("double").alias("score"))


YEARLY = f"""base AS (
    SELECT l_suppkey, p_type, year(o_orderdate) AS year, o_orderstatus, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey),
  yearly AS (SELECT l_suppkey, p_type, year, {mean2("sum(price)", "count(*)")} AS score FROM base GROUP BY ALL)"""
GAP = """coalesce(CAST(CAST(score AS DECIMAL(18,2)) - lag(CAST(score AS DECIMAL(18,2)))
    OVER (PARTITION BY l_suppkey, p_type ORDER BY year) AS DOUBLE), 0) AS yearly_gap"""
WITHIN = "dense_rank() OVER (PARTITION BY l_suppkey, year ORDER BY score DESC, p_type) AS rank_within"
ACROSS = "dense_rank() OVER (PARTITION BY p_type, year ORDER BY score DESC, l_suppkey) AS rank_across"


@query(
    "win_avg",
    f"""WITH fine AS (SELECT l_suppkey, p_type, year(o_orderdate) AS year, o_orderpriority,
              {mean2("sum(CAST(l_extendedprice AS DECIMAL(18,2)))", "count(*)")} AS score
          FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
        means AS (SELECT l_suppkey, p_type, year, {mean2("sum(CAST(score AS DECIMAL(18,2)))", "count(*)")} AS avg_score
                  FROM fine GROUP BY ALL)
      SELECT fine.*, avg_score FROM fine JOIN means USING (l_suppkey, p_type, year)""",
)
def win_avg(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderpriority")
    fine = joins.star_resolve(
        lines,
        [
            joins.Dim(table(spark, sf, "part"), "l_partkey", "p_partkey", ("p_type",)),
            joins.Dim(orders, "l_orderkey", "o_orderkey", ("year", "o_orderpriority")),
        ],
    )
    by = ["l_suppkey", "p_type", "year"]
    score = F.round(F.avg(F.col("l_extendedprice").cast(agg.MONEY)), 2).cast("double").alias("score")
    held = cut(fine.groupBy(*by, "o_orderpriority").agg(score))
    return windows.group_mean(held, by, "score", "avg_score", n_rows=held.count())


@query("lag_delta", f"WITH {YEARLY} SELECT *, {GAP} FROM yearly")
def lag_delta(spark, sf):
    scores = cut(yearly_scores(spark, sf))
    return windows.period_delta(scores, ["l_suppkey", "p_type"], "year", "score", "yearly_gap", n_rows=scores.count())


@query("rank_within", f"WITH {YEARLY} SELECT *, CAST({WITHIN.split(' AS ')[0]} AS INTEGER) AS rank_within FROM yearly")
def rank_within(spark, sf):
    scores = cut(yearly_scores(spark, sf))
    return windows.rank_in_group(scores, ["l_suppkey", "year"], ["-score", "p_type"], "rank_within", dense=True, n_rows=scores.count())


@query("rank_across", f"WITH {YEARLY} SELECT *, CAST({ACROSS.split(' AS ')[0]} AS INTEGER) AS rank_across FROM yearly")
def rank_across(spark, sf):
    scores = cut(yearly_scores(spark, sf))
    # A low bound sends the larger groups through the distributed sort.
    return windows.rank_in_group(scores, ["p_type", "year"], ["-score", "l_suppkey"], "rank_across", dense=True, group_rows=99)


@query(
    "score_fact",
    f"""WITH {YEARLY} SELECT *, {GAP}, CAST({WITHIN.split(' AS ')[0]} AS INTEGER) AS rank_within,
        CAST({ACROSS.split(' AS ')[0]} AS INTEGER) AS rank_across FROM yearly""",
)
def score_fact(spark, sf):
    """The flagship: star resolution, yearly means, change to the year before, two rankings."""
    scores = cut(yearly_scores(spark, sf))
    n = scores.count()
    gaps = windows.period_delta(scores, ["l_suppkey", "p_type"], "year", "score", "yearly_gap", n_rows=n)
    within = windows.rank_in_group(gaps, ["l_suppkey", "year"], ["-score", "p_type"], "rank_within", dense=True, n_rows=n)
    return windows.rank_in_group(within, ["p_type", "year"], ["-score", "l_suppkey"], "rank_across", dense=True, n_rows=n)


@query(
    "entity_order",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, {", ".join(LINE[1:])}) AS INTEGER) AS pos
        FROM lineitem""",
)
def entity_order(spark, sf):
    lines = table(spark, sf, "lineitem").drop("l_shipdate")
    ranked = windows.rank_in_group(lines, ["l_orderkey"], ["l_partkey", "l_suppkey", *LINE[1:]], "pos")
    return ranked.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "pos")


@query(
    "topn_per_group",
    """SELECT lang, source, doc_id, n_chars, CAST(rn AS INTEGER) AS rn FROM (
         SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn <= 5""",
)
def topn_per_group(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "source", "doc_id", "n_chars")
    return windows.first_in_group(docs, ["lang"], ["-n_chars", "doc_id"], 5)


@query("sort_multi", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def sort_multi(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        "o_orderpriority", F.desc("o_totalprice"), "o_orderkey"
    )


@query(
    "topk",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998 ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def topk(spark, sf):
    day = F.col("o_orderdate")
    one_year = (day >= F.lit("1998-01-01").cast("timestamp")) & (day < F.lit("1999-01-01").cast("timestamp"))
    return windows.top(table(spark, sf, "orders").filter(one_year).select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 10)


@query("latest_rows", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 10")
def latest_rows(spark, sf):
    return windows.top(table(spark, sf, "events").select("event_id", "ts", "event_type"), ["-ts", "event_id"], 10)


@query("topk_groups", "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def topk_groups(spark, sf):
    return windows.top_groups(table(spark, sf, "documents"), ["source"], 10)


@query(
    "topk_unmapped",
    """SELECT source, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
       GROUP BY source ORDER BY n DESC, source LIMIT 15""",
)
def topk_unmapped(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    return windows.top_groups(docs.filter(F.col("quality").isNull()), ["source"], 15)


@query(
    "sentiment_daily",
    """SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'click') AS click,
              count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'error') AS error,
              count(*) AS total FROM events GROUP BY 1, 2""",
)
def sentiment_daily(spark, sf):
    return agg.counts_by_label(table(spark, sf, "events"), ["user_id", F.to_date("ts").alias("day")], "event_type", ["click", "view", "error"])


@query(
    "label_vocab",
    """SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM
       (SELECT lang AS label FROM documents UNION SELECT source FROM documents)""",
)
def label_vocab(spark, sf):
    docs = table(spark, sf, "documents").select(split_labels(F.concat_ws("|", "lang", "source")).alias("labels"))
    return keys.surrogate_key(agg.vocabulary(docs, "labels"), "label_id", ["label"], start=0)
