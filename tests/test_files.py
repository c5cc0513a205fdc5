"""Tables, file round trips and loading files once."""

import os

import pytest
from pyspark.sql import functions as F

from lakemill.catalog import GOLD_SOCIAL, GOLD_STAR, SILVER
from lakemill.operators import clean
from lakemill.plans import silver
from lakemill.sinks.tables import Lake, compact, write
from lakemill.sources import csv_files
from lakemill.streaming import ledger

from .conftest import RUN_TS, rows


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"db_{tmp_path.name}".replace("-", "_"), str(tmp_path / "lake"), SILVER)


def test_registry_creates_all_tables(spark, tmp_path):
    for i, schemas in enumerate((SILVER, GOLD_STAR, GOLD_SOCIAL)):
        home = Lake(spark, f"registry_{i}", str(tmp_path / str(i)), schemas)
        home.create_all()
        home.create_all()
        assert home.list_tables() == sorted(t.lower() for t in schemas)
        for t, (schema, by) in schemas.items():
            assert sorted(home.read(t).columns) == sorted(schema.names)
            assert home.partitions(t) == by
            assert home.read(t).count() == 0


def test_replace_reads_itself_and_keeps_old_on_failure(spark, lake):
    lake.replace("n", spark.range(5))
    lake.replace("n", lake.read("n").filter("id > 1"))
    assert rows(lake.read("n")) == [(2,), (3,), (4,)]
    with pytest.raises(Exception):
        lake.replace("n", lake.read("n").select(F.raise_error(F.lit("stop")).alias("id")))
    assert rows(lake.read("n")) == [(2,), (3,), (4,)]


def test_append_creates_then_adds(spark, lake):
    lake.append("n", spark.range(2))
    lake.append("n", spark.range(2, 3))
    assert rows(lake.read("n")) == [(0,), (1,), (2,)]


def benchmark(spark, data):
    df = spark.createDataFrame(data, "schoolId string, majorId string, year int, score double")
    rest = {c: F.lit(1) for c in ("subjectGroupId", "selectionMethodId", "gradingScaleId")}
    return clean.with_audit(df.withColumns(rest), RUN_TS)


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, lake):
    key = ["schoolId", "majorId", "subjectGroupId", "selectionMethodId", "gradingScaleId", "year"]
    lake.upsert("benchmark", benchmark(spark, [("A", "m", 2022, 1.0), ("A", "m", 2023, 2.0), ("B", "m", 2023, 3.0)]), key, ["score"])

    def files(year):
        return {r[0] for r in lake.read("benchmark").filter(F.col("year") == year).select("_metadata.file_path").distinct().collect()}

    old = files(2022)
    lake.upsert("benchmark", benchmark(spark, [("B", "m", 2023, 9.0), ("C", "m", 2024, 4.0)]), key, ["score"])
    want = [("A", 2022, 1.0), ("A", 2023, 2.0), ("B", 2023, 9.0), ("C", 2024, 4.0)]
    assert rows(lake.read("benchmark"), "schoolId", "year", "score") == want
    assert files(2022) == old
    lake.upsert("benchmark", benchmark(spark, [("B", "m", 2023, 9.0), ("C", "m", 2024, 4.0)]), key, ["score"])
    assert rows(lake.read("benchmark"), "schoolId", "year", "score") == want


def test_replace_by_key_in_home_partition(spark, lake):
    def students(data):
        df = spark.createDataFrame(data, "studentId string, regionId string, year int, scores map<int,double>")
        return clean.with_audit(df, RUN_TS)

    lake.replace_by_key("student_scores", students([("12021", "01", 2021, {1: 2.0}), ("22022", "01", 2022, {1: 3.0})]), ["studentId"], ["studentId"], ["year"])
    lake.replace_by_key("student_scores", students([("22022", "02", 2022, {2: 4.0}), ("32023", "03", 2023, {})]), ["studentId"], ["studentId"], ["year"])
    assert rows(lake.read("student_scores"), "studentId", "regionId", "year") == [("12021", "01", 2021), ("22022", "02", 2022), ("32023", "03", 2023)]


def test_a_row_that_moves_leaves_its_partition(spark, lake):
    def posts(data):
        df = spark.createDataFrame(data, "articleID string, url string, t string, likeCount int")
        rows_ = df.select("articleID", "url", F.to_timestamp("t").alias("timePublish"), "likeCount")
        return clean.with_audit(rows_.withColumn("type", F.lit("facebook")), RUN_TS)

    def files(day):
        return {r[0] for r in lake.read("article").filter(F.col("timePublish_day") == day).select("_metadata.file_path").distinct().collect()}

    lake.append("article", posts([("a", "u/a", "2024-01-01 1:00:00", 1), ("b", "u/b", "2024-01-02 1:00:00", 2), ("c", "u/c", "2024-01-05 1:00:00", 3)]))
    untouched = files("2024-01-05")
    batch = lake.fit("article", posts([("a", "u/a", "2024-01-02 2:00:00", 9), ("n", "u/n", "2024-01-09 2:00:00", 4)]))
    for _ in range(2):
        lake.rewrite("article", batch, ["url", "type"], silver.merge_facebook_posts)
        got = rows(lake.read("article"), "articleID", F.col("timePublish_day").cast("string"), "likeCount")
        assert got == [("a", "2024-01-02", 9), ("b", "2024-01-02", 2), ("c", "2024-01-05", 3), ("n", "2024-01-09", 4)]
        assert files("2024-01-05") == untouched
    lake.append("article", posts([("d", "u/d", "2024-01-01 3:00:00", 5)]))
    assert rows(lake.read("article").filter("timePublish_day = date'2024-01-01'"), "articleID") == [("d",)]


def test_update_only(spark, lake):
    lake.replace("t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    lake.update("t", spark.createDataFrame([(2, None), (3, "c")], "k int, v string"), ["k"], ["v"])
    assert rows(lake.read("t")) == [(1, "a"), (2, None)]


def test_day_partitions(spark, lake):
    raw = spark.createDataFrame([("p1", "2024-03-01 10:00:00"), ("p2", None)], "articleID string, t string")
    lake.append("article", raw.select("articleID", F.to_timestamp("t").alias("timePublish")))
    assert lake.partitions("article") == ["timePublish_day"]
    one = lake.read("article").filter("timePublish_day = date'2024-03-01'")
    assert rows(one, "articleID") == [("p1",)]
    assert lake.read("article").count() == 2


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "c")
    write(compact(spark.range(1000).repartition(50), 1000, 300), path, rows_per_file=300)
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().select("count")
    assert all(r[0] <= 300 for r in sizes.collect())
    assert spark.read.parquet(path).count() == 1000


def test_exact_field_count(spark, tmp_path):
    put(str(tmp_path / "x.csv"), 'a,b,c\n1,"x, y",z\n1,2\n1,2,3,4\n"q ""r""",,s\n')
    got = csv_files.read_exact(spark, str(tmp_path / "x.csv"), ["a", "b", "c"])
    assert rows(got) == sorted([("1", "x, y", "z"), ('q "r"', None, "s")], key=repr)


def test_tagged_sources_skip_the_unreadable(spark, tmp_path):
    put(str(tmp_path / "2021.csv"), "a,b\n1,2\n")
    put(str(tmp_path / "2022.csv"), "b,a,c\n3,4,5\n")
    sources = {y: str(tmp_path / f"{y}.csv") for y in (2021, 2022, 2023)}
    got = csv_files.read_tagged(spark, sources, "year")
    assert rows(got, "a", "b", "c", "year") == [("1", "2", None, 2021), ("4", "3", "5", 2022)]
    with pytest.raises(Exception):
        csv_files.read_tagged(spark, {1: str(tmp_path / "none.csv")}, "year").count()


def load(spark, base, calls=1, **options):
    for _ in range(calls):
        report = ledger.load_new_files(
            spark, f"{base}/in", f"{base}/rows", f"{base}/ledger", lambda df: df.select("ID", "v", "source_file"), "ID", RUN_TS, **options
        )
    return report


def test_each_file_is_loaded_once(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in/năm 2021/điểm 1.csv", "ID,v\n1,a\n2,b\n")
    put(f"{base}/in/năm 2021/100%.csv", "v,ID\nc,3\n")
    put(f"{base}/in/bad.csv", "other,v\n9,z\n")
    report = load(spark, base, calls=2, files_per_batch=2)
    read = spark.read.parquet(f"{base}/rows")
    assert rows(read, "ID", "v") == [("1", "a"), ("2", "b"), ("3", "c")]
    assert rows(report.groupBy("status").count()) == [("loaded", 2), ("no_key_column", 1)]
    put(f"{base}/in/năm 2022/điểm 1.csv", '"ID","v"\n4,d\n')
    load(spark, base)
    assert rows(spark.read.parquet(f"{base}/rows"), "ID", "v") == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]


def test_a_failed_run_is_finished_without_copies(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in/a.csv", "ID,v\n1,a\n")

    def fail(df):
        df.select("ID", "v", "source_file").write.parquet(f"{base}/rows/ingest_run=half")
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        ledger.load_new_files(spark, f"{base}/in", f"{base}/other", f"{base}/ledger", fail, "ID", RUN_TS)
    put(f"{base}/in/b.csv", "ID,v\n2,b\n")
    run = ledger.read_ledger(spark, f"{base}/ledger").first()["run"]
    os.rename(f"{base}/rows/ingest_run=half", f"{base}/rows/ingest_run={run}")
    load(spark, base, calls=2)
    assert rows(spark.read.parquet(f"{base}/rows"), "ID", "v") == [("1", "a"), ("2", "b")]


def test_stream_takes_only_new_files(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in/a.csv", "id,v\n1,a\n")
    for text in ("id,v\n2,b\n", "id,v\n3,c\n"):
        ledger.stream_new_files(spark, f"{base}/in", f"{base}/rows", f"{base}/ck", "id int, v string", lambda b: b.select("id", "v"))
        put(f"{base}/in/{text[5]}.csv", text)
    assert rows(spark.read.parquet(f"{base}/rows"), "id", "v") == [(1, "a"), (2, "b")]
