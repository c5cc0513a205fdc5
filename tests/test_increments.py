"""Loads that work out only what changed, and changes left to the catalog or to one job."""

import pytest
from pyspark.sql import functions as F

from lakemill.catalog import GOLD_STAR, SILVER
from lakemill.operators import changes, clean, joins
from lakemill.plans import feeds, loads, star
from lakemill.sinks.tables import Lake
from lakemill.sources import csv_files
from lakemill.streaming import ledger

from .conftest import RUN_TS, rows
from .test_files import put
from .test_plans import LATER, write_bronze


class Spied:
    """A session whose SQL statements are listed; those that ``stop`` names are not carried out."""

    def __init__(self, spark, stop=None):
        self._spark, self._stop, self.said = spark, stop, []

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def sql(self, text, *args, **kwargs):
        self.said.append(text)
        return None if self._stop and text.startswith(self._stop) else self._spark.sql(text, *args, **kwargs)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"inc_{tmp_path.name}".replace("-", "_"), str(tmp_path / "lake"), SILVER)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("increments"))
    bronze = write_bronze(base)
    silver, gold = Lake(spark, "inc_silver", f"{base}/silver", SILVER), Lake(spark, "inc_gold", f"{base}/gold", GOLD_STAR)
    loads.bronze_to_silver(spark, silver, bronze, RUN_TS)
    loads.silver_to_star(silver, gold)
    return base, bronze, silver, gold


def distributions(silver, gold, read=None):
    """Both facts as the gold tables have them, or worked out from the whole table."""
    if read is None:
        return [rows(gold.read(f"fact_score_distribution_by_{t}").drop("SDBSKey", "SDBSGKey")) for t in ("subject", "subject_group")]
    dims = {t: gold.read(t) for t in gold.list_tables() if t.startswith("dim_")}
    whole = [
        star.fact_score_distribution_by_subject(silver.read("student_scores"), dims),
        star.fact_score_distribution_by_subject_group(silver.read("student_scores"), silver.read("subject_group"), silver.read("subject"), dims),
    ]
    return [rows(w.select(*[c for c in gold.read(f"fact_score_distribution_by_{t}").columns if c not in ("SDBSKey", "SDBSGKey")])) for w, t in zip(whole, ("subject", "subject_group"), strict=True)]


def test_two_loads_equal_one_and_count_only_new_students(spark, world, monkeypatch):
    base, bronze, silver, gold = world
    assert distributions(silver, gold) == distributions(silver, gold, "whole") and any(distributions(silver, gold))
    # One student comes again with other scores, one is new.
    put(f"{base}/điểm/2023/b.csv", 'SBD,DiemThi\n01000001,"Toán:3.1,Lý:4,Hoá:5"\n48000009,"Toán:7,Lý:7,Hoá:7"\n')
    counted = []
    real = feeds.Runs.put
    monkeypatch.setattr(feeds.Runs, "put", lambda self, run, rows_: (counted.append((self.root.rsplit("/", 1)[-1], rows_)), real(self, run, rows_))[1])
    loads.load_student_scores(spark, silver, bronze, LATER)
    loads.silver_to_star(silver, gold)
    assert distributions(silver, gold) == distributions(silver, gold, "whole")
    assert [name.split("-")[0] for name, _ in counted] == ["student_scores", "by_subject", "by_group"]
    changes = feeds.feed(silver, "student_scores")
    runs = changes.complete()
    (newest,) = [r for r in runs if changes.read({r}).filter("studentId LIKE '48000009%'").count()]
    assert sorted(r[0] for r in changes.read({newest}).select(feeds.SIGN).collect()) == [-1, 1, 1]
    counted.clear()
    loads.silver_to_star(silver, gold)
    assert counted == []


def test_a_run_noted_before_a_stop_is_not_noted_again(spark, world):
    _, _, silver, _ = world
    batch = silver.read("student_scores").limit(1)
    log = feeds.feed(silver, "student_scores")
    feeds.put_changes(silver, "student_scores", "stopped", batch, ["studentId"], ["year"])
    first = rows(log.read({"stopped"}), "studentId", feeds.SIGN)
    again = feeds.put_changes(silver, "student_scores", "stopped", batch.limit(0), ["studentId"], ["year"])
    assert rows(log.read({"stopped"}), "studentId", feeds.SIGN) == first and again.count() == 1
    assert [s for _, s in first] == [-1, 1]


def test_other_groups_begin_counts_of_their_own(spark, world):
    base, bronze, silver, gold = world
    put(f"{base}/tổ hợp.csv", "id,ten,mon\n1,A00,Toán-Lý\n2,D01,Toán - Ngữ văn-Anh\n")
    loads.load_reference_tables(spark, silver, bronze, LATER)
    loads.silver_to_star(silver, gold)
    assert distributions(silver, gold) == distributions(silver, gold, "whole")


def test_merge_is_left_to_a_catalog_that_has_it(spark, lake, monkeypatch):
    lake.replace("t", spark.createDataFrame([(1, "a", 0)], "k int, v string, w int"))
    source = spark.createDataFrame([(1, "b", 5), (2, "c", 6)], "k int, v string, w int")
    assert lake.provider("t") == "parquet"
    lake.spark = Spied(spark, "MERGE")
    monkeypatch.setattr(lake, "provider", lambda t: "iceberg")
    lake.upsert("t", source, ["k"], ["v"])
    lake.update("t", source, ["k"], ["v"])
    both, only_update = [s for s in lake.spark.said if s.startswith("MERGE")]
    assert "ON t.k <=> s.k WHEN MATCHED THEN UPDATE SET t.v = s.v WHEN NOT MATCHED THEN INSERT (`k`, `v`, `w`) VALUES (s.`k`, s.`v`, s.`w`)" in both
    assert only_update.endswith("UPDATE SET t.v = s.v")
    lake.spark = spark
    monkeypatch.setattr(lake, "provider", lambda t: "parquet")
    lake.upsert("t", source, ["k"], ["v"])
    assert rows(lake.read("t")) == [(1, "b", 0), (2, "c", 6)]


def test_many_partitions_change_in_one_job(spark, lake):
    n = 400
    lake.replace("p", spark.range(2 * n).select("id", (F.col("id") % n).cast("int").alias("day"), F.lit("old").alias("v")), partition_by=["day"])
    lake.spark = Spied(spark)
    batch = spark.range(n).select("id", (F.col("id") % n).cast("int").alias("day"), F.lit("new").alias("v"))
    lake.rewrite("p", batch, ["id", "day"], lambda t, b: t.join(b.select("id", F.lit(1).alias("hit")), "id", "left").select("id", F.when(F.col("hit") == 1, "new").otherwise(F.col("v")).alias("v"), "day"))
    assert rows(lake.read("p").groupBy("v").count()) == [("new", n), ("old", n)]
    assert lake.spark.said == []
    lake.replace("p", lake.read("p").filter("day < 390").select("id", "day", "v"), partition_by=["day"])
    assert len(lake.spark.said) <= 5
    assert lake.read("p").count() == 780 and spark.sql(f"SHOW PARTITIONS {lake.name('p')}").count() == 390


def test_a_failed_change_leaves_all_partitions(spark, lake):
    lake.replace("p", spark.range(10).select("id", (F.col("id") % 3).cast("int").alias("day")), partition_by=["day"])
    stop = F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")).alias("id")
    with pytest.raises(Exception, match="stop"):
        lake.rewrite("p", spark.range(3).select("id", F.col("id").cast("int").alias("day")), ["id", "day"], lambda t, b: t.select(stop, "day"))
    assert rows(lake.read("p"), "id") == [(i,) for i in range(10)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_a_range_of_times_reads_only_its_days(spark, lake):
    raw = spark.createDataFrame([(f"a{i}", f"2024-03-{i:02d} 10:00:00") for i in range(1, 20)], "articleID string, t string")
    lake.append("article", clean.with_audit(raw.select("articleID", F.to_timestamp("t").alias("timePublish")), RUN_TS))
    some = lake.read_between("article", "timePublish", "2024-03-04 09:00:00", "2024-03-06 10:00:00")
    assert rows(some, "articleID") == [("a4",), ("a5",)]
    shown = some._sc._jvm.PythonSQLUtils.explainString(some._jdf.queryExecution(), "formatted")
    filters = shown.split("PartitionFilters: [")[1].split("\n")[0]
    assert "timePublish_day" in filters and ">=" in filters and "<=" in filters
    assert len(some.inputFiles()) >= 1


def test_files_are_read_once(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    for i, header in enumerate(["ID,v", "v,ID", "ID,w,v", '"v","ID"']):
        put(f"{base}/in/{i}.csv", f'{header}\n1,2,3\n\n"x, y",5\n')
    put(f"{base}/in/no.csv", "a,b\n1,2\n")
    read = []
    real = csv_files.read_lines
    monkeypatch.setattr(ledger, "read_lines", lambda s, p: (read.append(list(p)), real(s, p))[1])
    ledger.load_new_files(spark, f"{base}/in", f"{base}/rows", f"{base}/ledger", lambda df: df, "ID", RUN_TS)
    assert len(read) == 1 and len(read[0]) == 5
    got = rows(spark.read.parquet(f"{base}/rows"), "ID", "v", "w")
    want = [("1", "2", None), ("x, y", "5", None), ("2", "1", None), ("5", "x, y", None), ("1", "3", "2"), ("x, y", None, "5"), ("2", "1", None), ("5", "x, y", None)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("by", [None, ["year"]])
def test_a_bucketed_target_is_not_shuffled(spark, tmp_path, by):
    lake = Lake(spark, f"buckets_{tmp_path.name}", str(tmp_path / "lake"), buckets={"s": (8, ["id"])})
    people = spark.range(3000).select("id", (F.col("id") % 3).cast("int").alias("year"), F.lit("old").alias("v"))
    lake.replace("s", people, partition_by=by)
    batch = spark.range(2900, 3100).select("id", (F.col("id") % 3).cast("int").alias("year"), F.lit("new").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for changed, side in (
            (changes.replace_by_key(lake.read("s"), batch, ["id"], ["id"], null_safe=False), "batch"),
            (joins.new_rows(lake.read("s"), batch, "id"), "batch"),
            (joins.new_rows(batch, lake.read("s"), "id"), "table"),
        ):
            plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(changed._jdf.queryExecution(), "simple")
            lines = plan.split("\n")
            scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
            above = [line for line in lines[:scan] if len(line) - len(line.lstrip(" :+-")) < len(lines[scan]) - len(lines[scan].lstrip(" :+-"))]
            on_path, depth = [], len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
            for line in reversed(above):
                d = len(line) - len(line.lstrip(" :+-*()0123456789"))
                if d < depth:
                    on_path.append(line)
                    depth = d
            join = next(i for i, line in enumerate(on_path) if "Join" in line)
            assert not any("Exchange" in line for line in on_path[:join]), (side, plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lake.replace_by_key("s", batch, ["id"], ["id"], home=by)
    assert rows(lake.read("s").groupBy("v").count()) == [("new", 200), ("old", 2900)]
    lake.append("s", batch.filter("id > 3090").select(*lake.read("s").columns))
    assert lake.read("s").count() == 3109
    # Every key is still in its own bucket.
    bucket = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{5})\.c000", 1)
    placed = lake.read("s").select("id", bucket.alias("b")).groupBy("id").agg(F.count_distinct("b").alias("n"))
    assert placed.filter("n <> 1").count() == 0 and lake.read("s").select(bucket).distinct().count() == 8
