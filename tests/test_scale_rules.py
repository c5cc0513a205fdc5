"""Bounds that only change the plan, values beyond 32 bits, broken files, ids that stay, changes that fail midway."""

import gzip
import os
from decimal import ROUND_HALF_UP, Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakemill.functions import minitext, scalar, spans
from lakemill.catalogue import flows
from lakemill.operators import aggregates, bounds, keys, quality, training, windows
from lakemill.plans import silver, social, star
from lakemill.operators import scoring
from lakemill.sinks.tables import Lake, write
from lakemill.sources import csv_files
from lakemill.streaming import ledger

from .conftest import RUN_TS, SMALL, rows
from .test_files import load, put


def members(spark, n_groups):
    data = [(g, m, 3) for g in range(n_groups) for m in (g, g + 1, g + 2)]
    return spark.createDataFrame(data, "grp int, member int, n_members int")


@pytest.mark.parametrize("n_groups", [2, 12_000])
def test_group_totals_do_not_depend_on_the_number_of_groups(spark, n_groups):
    data = [("a", {0: 1.0, 1: 1.0, 2: 1.0}), ("a", {0: 2.0, 1: 2.0, 2: 2.0}), ("b", {0: 1.0, 1: None, 2: 3.0}), ("c", None), ("d", {})]
    df = spark.createDataFrame(data, "id string, scores map<int,double>")
    got = aggregates.complete_sum_of_maps(df, ["id"], "scores", members(spark, n_groups), "grp", "total")
    assert rows(got) == [("a", 0, 3.0), ("a", 0, 6.0)]


def test_totals_are_those_of_decimals_and_plain_scores_are_summed_as_whole_numbers(spark):
    values = [(0.1, 0.2, 0.3), (8.25, 7.75, -0.0), (-0.0, -0.0, -0.0), (0.00005, 1.0, 2.0), (1e5, 0.1, 0.2), (99999.9999, 99999.9999, 0.0001), (-3.3, 1.1, 2.2), (1e9, 0.1, 0.7)]
    df = spark.createDataFrame([(i, dict(enumerate(v))) for i, v in enumerate(values)], "id int, scores map<int,double>")
    sums = aggregates.complete_sum_of_maps(df, ["id"], "scores", members(spark, 1), "grp", "total")
    places = Decimal("0.0001")
    want = [(i, 0, float(sum(Decimal(repr(x)).quantize(places, ROUND_HALF_UP) for x in v))) for i, v in enumerate(values)]
    assert rows(sums) == want
    assert "rint(" in sums._jdf.queryExecution().optimizedPlan().toString()


def test_students_are_sorted_by_a_hash_of_their_ids_first(spark):
    raw = spark.createDataFrame([("01000001", "Q:1", "/b/2020/a.csv"), ("01000001", "Q:2", "/b/2020/b.csv"), ("01000001", "Q:3", "/b/2021/a.csv")], "SBD string, DiemThi string, path string")
    got = silver.student_scores(raw, spark.createDataFrame([(1, "Q")], "subjectId int, subjectName string"))
    assert rows(got, "studentId", "scores") == [("010000012020", {1: 2.0}), ("010000012021", {1: 3.0})]
    assert "xxhash64(studentId" in got._jdf.queryExecution().optimizedPlan().toString()


def test_only_texts_with_other_white_space_than_blanks_are_stripped_of_all(spark):
    texts = [f"{x}Q{x}:{x}1.5{x},{x}T:2" for x in scalar.SPACE] + ["Q\u2603:1,T: 2 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = df.select(minitext.parse_map("t"), F.col("t").rlike(minitext.OTHER_SPACE)).collect()
    assert [tuple(r) for r in got] == [({"Q": 1.5, "T": 2.0}, x != " ") for x in scalar.SPACE] + [({"Q\u2603": 1.0, "T": 2.0}, True)]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_totals_of_rows_and_of_maps_agree_on_both_sides_of_the_bound(spark, limit, monkeypatch):
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", limit)
    df = spark.createDataFrame([(i, {m: float(m) for m in range(i % 5)}) for i in range(60)], "id int, scores map<int,double>")
    long = df.select("id", F.explode("scores").alias("member", "v"))
    one = aggregates.complete_sum(long, ["id"], "member", "v", members(spark, 4), "grp", "total")
    other = aggregates.complete_sum_of_maps(df, ["id"], "scores", members(spark, 4), "grp", "total")
    assert rows(one, "id", "grp", "total") == rows(other, "id", "grp", "total") != []


@pytest.mark.parametrize("parts", [1, 9])
def test_numbers_do_not_depend_on_the_partitions(spark, parts):
    df = spark.createDataFrame([(i * 7 % 101, str(i)) for i in range(101)], "k int, v string").repartition(parts)
    assert sorted(rows(keys.surrogate_key(df, "n", ["k"]), "k", "n")) == [(k, k + 1) for k in range(101)]


@pytest.mark.parametrize("limit", [3, 10**6])
def test_ranks_and_deltas_do_not_depend_on_the_bound(spark, limit):
    df = spark.createDataFrame([(i % 2, i, float(i * i % 7)) for i in range(20)], "g int, p int, v double")
    ranked = windows.rank_in_group(df, ["g"], ["-v", "p"], "r", group_rows=limit)
    delta = windows.period_delta(df, ["g"], "p", "v", "d", group_rows=limit)
    mean = windows.group_mean(df, ["g"], "v", "m", group_rows=limit)
    want = windows.rank_in_group(df, ["g"], ["-v", "p"], "r")
    assert rows(ranked.select("g", "p", "r")) == rows(want.select("g", "p", "r"))
    assert rows(delta.select("g", "p", "d")) == rows(windows.period_delta(df, ["g"], "p", "v", "d").select("g", "p", "d"))
    assert rows(mean.select("g", "p", "m")) == rows(windows.group_mean(df, ["g"], "v", "m").select("g", "p", "m"))


def test_a_broadcast_is_bounded_in_bytes(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 10_000).alias("t"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(bounds.checked_broadcast(wide, size=1 << 20))
    assert not hinted(bounds.checked_broadcast(wide, size=1 << 10))
    assert not hinted(bounds.checked_broadcast(wide, limit=9))


def test_large_numbers_stay(spark):
    df = spark.createDataFrame([("3000M",), ("3000000000",), ("1.2K",), ("x",), (None,)], "t string").coalesce(1)
    got = df.select(scalar.magnitude("t"), scalar.int_or("t")).collect()
    assert [tuple(r) for r in got] == [(3_000_000_000, 0), (3_000_000_000, 3_000_000_000), (1200, 0), (0, 0), (0, 0)]
    value = spark.createDataFrame([(0.6,), (9.5e12,), (1e15 + 0.4,), (-0.1,)], "v double")
    assert [r[0] for r in value.select(scalar.floor_bin("v", "0.2")).collect()] == [0.6, 9.5e12, 1e15 + 0.4, -0.2]


def test_a_value_too_large_for_its_column_is_null_and_counted(spark, tmp_path):
    from lakemill.catalog import SILVER

    home = Lake(spark, "misfit_db", str(tmp_path / "lake"), SILVER)
    df = spark.createDataFrame([("a", 3_000_000_000), ("b", 5)], "articleID string, likeCount bigint")
    assert rows(home.fit("article", df), "articleID", "likeCount") == [("a", None), ("b", 5)]
    assert ("likeCount", 1) in rows(home.misfits("article", df))


def test_long_types_and_many_labels(spark):
    long_type = "T" * 1_200_000
    df = spark.createDataFrame([(f"B-{long_type}", "w")], "tags string, text string")
    found = df.select(spans.bio_spans("tags", "text").alias("s"), spans.tag_types("tags").alias("t")).first()
    assert found["s"][0]["entityType"] == long_type == found["t"][0]
    assert df.select(minitext.labels_above(F.array(F.lit(0.9), F.lit(0.1)), ["a"])).first()[0] is None
    many = spark.range(12_000).select(F.array(F.col("id").cast("string")).alias("l"))
    known = many.withColumn("known", minitext.sorted_values(many.select(F.explode("l").alias("x")), "x"))
    vectors = known.select(minitext.multi_hot("l", F.col("known")).alias("v"))
    assert vectors.filter((F.size("v") == 12_000) & (F.aggregate("v", F.lit(0), lambda a, x: a + x) == 1)).count() == 12_000


def test_a_broken_file_is_set_aside_and_the_rest_is_loaded(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in/a.csv", "ID,v\n1,a\n")
    put(f"{base}/in/c.csv", "v,ID\nc,3\n")
    whole = gzip.compress(("ID,v\n" + "".join(f"{i},{i * 7919 % 10007}\n" for i in range(50_000))).encode())
    with open(f"{base}/in/b.csv.gz", "wb") as f:
        f.write(whole[: len(whole) // 2])
    report = load(spark, base, pattern="*.csv*")
    assert rows(report.groupBy("status").count()) == [("loaded", 2), ("unreadable", 1)]
    bad = report.filter("status = 'unreadable'").first()
    assert bad["path"].endswith("b.csv.gz") and bad["reason"]
    want = [("1", "a"), ("3", "c")]
    assert rows(spark.read.parquet(f"{base}/rows"), "ID", "v") == want
    again = load(spark, base, pattern="*.csv*")
    assert again.count() == 3
    assert rows(spark.read.parquet(f"{base}/rows"), "ID", "v") == want


def test_a_fault_of_the_transform_is_not_blamed_on_files(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in/a.csv", "ID,v\n1,a\n")
    broken = lambda df: df.select(F.raise_error(F.lit("no")).cast("string").alias("ID"))
    with pytest.raises(Exception, match="no"):
        ledger.load_new_files(spark, f"{base}/in", f"{base}/rows", f"{base}/ledger", broken, "ID", RUN_TS)
    load(spark, base)
    assert rows(spark.read.parquet(f"{base}/rows"), "ID", "v") == [("1", "a")]


def test_the_stream_reads_columns_by_name_and_lists_broken_files(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in/a.csv", "id,v\n1,a\n")
    put(f"{base}/in/b.csv", "v,id\nb,2\n")
    os.makedirs(f"{base}/in", exist_ok=True)
    whole = gzip.compress(("id,v\n" + "".join(f"{i},{i * 7919 % 10007}\n" for i in range(50_000))).encode())
    with open(f"{base}/in/c.csv.gz", "wb") as f:
        f.write(whole[: len(whole) // 2])
    for _ in range(2):
        ledger.stream_new_files(spark, f"{base}/in", f"{base}/rows", f"{base}/ck", "id int, v string", lambda b: b.drop("source_file"), pattern="*.csv*")
    assert rows(spark.read.parquet(f"{base}/rows"), "id", "v") == [(1, "a"), (2, "b")]
    assert spark.read.parquet(f"{base}/rows_unreadable").count() == 1


def test_files_whose_columns_differ_are_not_mixed_up(spark, tmp_path):
    put(str(tmp_path / "a.csv"), "k,v\n1,one\n")
    put(str(tmp_path / "b.csv"), "v,k\ntwo,2\n")
    with pytest.raises(Exception):
        csv_files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()


def test_ids_stay_when_names_that_sort_first_come_later(spark):
    first = silver.selection_method(spark.createDataFrame([("Zeta",), ("Eta",)], "PhuongThuc string"), RUN_TS).cache()
    later = silver.selection_method(spark.createDataFrame([("Alpha",), ("Zeta",)], "PhuongThuc string"), RUN_TS, first)
    assert rows(later, "selectionMethodId", "selectionMethodName") == [(1, "Eta"), (2, "Zeta"), (3, "Alpha")]
    raw = spark.createDataFrame([("1", "A00", "Toán-Lý")], "id string, ten string, mon string")
    subjects = silver.subject(raw, RUN_TS).cache()
    more = spark.createDataFrame([("1", "A00", "Anh-toán-Lý")], "id string, ten string, mon string")
    assert rows(silver.subject(more, RUN_TS, subjects), "subjectId", "subjectName") == [(1, "Lý"), (2, "Toán"), (3, "Anh")]


def test_rows_without_ids_are_refused_on_every_run(spark):
    data = [("a", None, "1", "1", "1", "t", "x y"), (None, None, "1", "1", "1", "t", "z")]
    articles = spark.createDataFrame(data, "articleID string, timePublish timestamp, likeCount string, commentCount string, shareCount string, type string, description string")
    scorer = scoring.shape_scorer({})
    first = social.model_results(articles, None, scorer, RUN_TS).cache()
    assert rows(first, "postID") == [("a",)]
    assert social.model_results(articles, first, scorer, RUN_TS).count() == 0


def test_a_change_that_fails_midway_leaves_the_table_whole(spark, tmp_path):
    home = Lake(spark, "midway_db", str(tmp_path / "lake"))
    home.replace("t", spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, p int"), ["p"])
    boom = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string").withColumn(
        "v", F.when(F.col("k") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception):
        home.rewrite("t", spark.createDataFrame([(1,), (2,)], "k int"), ["k"], lambda t, b: t.drop("v").join(boom, "k").select("k", "v", "p"))
    assert rows(home.read("t"), "k", "v", "p") == [(1, "a", 1), (2, "b", 2)]
    home.update("t", spark.createDataFrame([(2, "z"), (9, "n")], "k int, v string"), ["k"], ["v"])
    assert rows(home.read("t"), "k", "v", "p") == [(1, "a", 1), (2, "z", 2)]


def test_more_partitions_than_any_list_and_null_and_quoted_values(spark, tmp_path):
    home = Lake(spark, "many_db", str(tmp_path / "lake"))
    names = ["it's", "a/b", "c=d", None, "é ü"]
    df = spark.range(40).select("id", F.get(F.array(*[F.lit(n) for n in names]), F.pmod("id", F.lit(7)).cast("int")).alias("p"))
    home.replace("t", df, ["p"])
    home.update("t", spark.range(40).select("id"), ["id"], [])
    home.replace("t", home.read("t").filter("id >= 5"), ["p"])
    want = sorted(((r["id"], r["p"]) for r in df.filter("id >= 5").collect()), key=repr)
    assert rows(home.read("t"), "id", "p") == want


def test_files_are_gzip(spark, tmp_path):
    path = str(tmp_path / "z")
    write(spark.range(10), path)
    name = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert pq.ParquetFile(f"{path}/{name}").metadata.row_group(0).column(0).compression == "GZIP"


def test_object_store_settings():
    from lakemill.session import s3a_conf

    conf = s3a_conf("http://store:9000", "key", "word", tls=True)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert (conf["spark.hadoop.fs.s3a.access.key"], conf["spark.hadoop.fs.s3a.secret.key"]) == ("key", "word")
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true" == conf["spark.hadoop.fs.s3a.path.style.access"]


def test_samples_cut_names_before_they_meet_their_type(spark):
    entities = spark.createDataFrame([(1, "MAJ", "m"), (2, "ORG", "o"), (3, "MAJ", "m")], "entityID int, entityType string, entityDetail string")
    bridge = spark.createDataFrame([(1 + i % 3, f"n{i // 6:03}") for i in range(90)] + [(2, None), (9, "a")], "entityID int, entityName string")
    got = quality.samples_per_type(entities, bridge)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan[plan.rindex("Join") :]
    assert rows(got, "entityType", "sample_value", "rn") == sorted(
        [("MAJ", f"n{i // 4:03}", i + 1) for i in range(5)] + [("ORG", f"n{i // 2:03}", i + 1) for i in range(5)]
    )


def test_fact_benchmark_counts_groups_in_stored_rows(spark, monkeypatch):
    seen, real = [], windows.hot_groups
    monkeypatch.setattr(windows, "hot_groups", lambda df, *rest: seen.append(df.columns) or real(df, *rest))
    assert flows.fact_benchmark(spark, SMALL).count() > 0
    assert len(seen) == 4 and not any("avgScoreByMajor" in columns for columns in seen)


def test_fact_benchmark_keeps_little_on_disk(spark, monkeypatch):
    seen, real = [], star.surrogate_key
    monkeypatch.setattr(star, "surrogate_key", lambda df, name, order: seen.append((name, df)) or real(df, name, order))
    before = {p for p in os.listdir(spark.conf.get("spark.checkpoint.dir")) if p.startswith(("raw-", "scores-", "facts-"))}
    facts = flows.fact_benchmark(spark, SMALL)
    assert facts.count() > 0
    after = {p for p in os.listdir(spark.conf.get("spark.checkpoint.dir")) if p.startswith(("raw-", "scores-", "facts-"))}
    assert after <= before
    measured = dict(seen)["benchmarkKey"]
    plan = measured._jdf.queryExecution().optimizedPlan().toString()
    physical = measured._jdf.queryExecution().executedPlan().toString()
    # Once for three measures and once for the last, of rows without the ids that keys settle.
    assert physical.count("Exchange ") == 2
    assert "year#" not in plan and "selectionMethodId" not in plan


def test_heads_are_fitted_on_written_features(spark, monkeypatch):
    seen, real = [], training.cut
    monkeypatch.setattr(training, "cut", lambda df: seen.append(df.columns) or real(df))
    df = spark.createDataFrame([("a b", "x", ["p"]), ("b c", "y", ["q"])] * 5, "text string, label string, labels array<string>")
    model = training.fit_single_label(df, "text", "label", 64, 3)
    assert {r["label"] == r["predicted"] for r in training.predict_single_label(model, df).collect()} == {True}
    training.fit_multi_label(df, "text", "labels", ["p", "q"], 64, 3)
    assert seen == [["label", "__tf"], ["labels", "__tf"]]
