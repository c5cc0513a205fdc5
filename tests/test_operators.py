"""Operators against brute force, with the paths for large groups forced on small data."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemill.functions import spans
from lakemill.operators import aggregates, aliases, changes, clean, joins, keys, windows
from lakemill.operators.evaluation import evaluate_multilabel, evaluate_ner, evaluate_weighted, hash_split

from .conftest import SMALL, rows

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def skewed(spark, n=3000):
    """A third of all rows in one group, some with a NULL key, values with ties."""
    r = random.Random(7)
    data = [(i, None if i % 11 == 0 else "hot" if i % 3 == 0 else f"g{i % 17}", r.randint(0, 40), r.randint(1, 9)) for i in range(n)]
    return spark.createDataFrame(data, "id long, grp string, score int, per int")


@pytest.mark.parametrize("parts", [1, 7])
def test_surrogate_key_is_dense_and_ordered(spark, parts):
    df = skewed(spark).repartition(parts)
    got = keys.surrogate_key(df, "k", ["-score", "id"])
    want = sorted(((-r["score"], r["id"]) for r in df.collect()))
    assert [r["id"] for r in got.orderBy("k").collect()] == [i for _, i in want]
    assert [r["k"] for r in got.orderBy("k").collect()] == list(range(1, len(want) + 1))


def test_surrogate_key_of_nothing(spark):
    assert keys.surrogate_key(skewed(spark).limit(0), "k", ["id"]).count() == 0


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("group_rows", [100, 10**6])
def test_rank_in_group(spark, dense, group_rows):
    df = skewed(spark)
    order = ["-score", "per"] if dense else ["-score", "id"]
    w = Window.partitionBy("grp").orderBy(F.desc("score"), order[1])
    want = df.withColumn("r", (F.dense_rank() if dense else F.row_number()).over(w))
    got = windows.rank_in_group(df, ["grp"], order, "r", dense=dense, group_rows=group_rows)
    assert rows(got, "id", "r") == rows(want, "id", "r")


@pytest.mark.parametrize("group_rows", [100, 10**6])
def test_period_delta(spark, group_rows):
    df = skewed(spark)
    w = Window.partitionBy("grp").orderBy("per", "id")
    want = df.withColumn("d", F.coalesce((F.col("score") - F.lag("score").over(w)).cast("double"), F.lit(0.0)))
    got = windows.period_delta(df, ["grp"], "per", "score", "d", ties=("id",), group_rows=group_rows)
    assert rows(got, "id", "d") == rows(want, "id", "d")


def test_period_delta_skips_gap_years(spark):
    df = spark.createDataFrame([("a", 2020, 1.5), ("a", 2023, 2.25), ("b", 2021, 9.0)], "k string, y int, v double")
    assert rows(windows.period_delta(df, ["k"], "y", "v", "d"), "k", "y", "d") == [("a", 2020, 0.0), ("a", 2023, 0.75), ("b", 2021, 0.0)]


@pytest.mark.parametrize("group_rows", [100, 10**6])
def test_group_mean_keeps_null_groups(spark, group_rows):
    df = skewed(spark)
    w = Window.partitionBy("grp")
    want = df.withColumn("m", F.round(F.avg(F.col("score").cast("decimal(18,2)")).over(w), 2).cast("double"))
    assert rows(windows.group_mean(df, ["grp"], "score", "m", group_rows=group_rows), "id", "m") == rows(want, "id", "m")


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_skew_lookup(spark, hot_rows):
    fact = skewed(spark)
    dim = spark.createDataFrame([(f"g{i}", i) for i in range(9)] + [("hot", 99)], "grp string, n int")
    got = joins.skew_lookup(fact, dim, "grp", ["n"], hot_rows=hot_rows)
    assert rows(got, "id", "n") == rows(fact.join(dim, "grp", "left"), "id", "n")


def test_groups_are_cut_before_the_shuffle(spark):
    df = skewed(spark)
    for plan in (clean.dedup_by(df, ["grp"], ["id"]), windows.first_in_group(df, ["grp"], ["id"], 3)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("WindowGroupLimit") == 2, text


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    plan = clean.project_cast(df.filter("o_orderstatus = 'F'"), {"k": ("o_orderkey", "bigint")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_expect_unique(spark):
    df = skewed(spark)
    assert joins.expect_unique(df, ["id"]) is df
    with pytest.raises(ValueError):
        joins.expect_unique(df, ["grp"])


def target(spark):
    return spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), ("b", 1, 3.0)], "k string, m int, v double")


def test_upsert(spark):
    source = spark.createDataFrame(
        [("a", None, 20.0, 1), ("a", None, 21.0, 2), ("b", 1, 3.0, 1), ("c", None, 5.0, 1)], "k string, m int, v double, n int"
    )
    once = changes.upsert(target(spark), source, ["k", "m"], ["v"], order=["-n"])
    assert rows(once) == sorted([("a", 1, 1.0), ("a", None, 21.0), ("b", 1, 3.0), ("c", None, 5.0)], key=repr)
    twice = changes.upsert(once, source, ["k", "m"], ["v"], order=["-n"])
    assert rows(twice) == rows(once)


def test_merge_update_takes_nulls_from_the_source(spark):
    source = spark.createDataFrame([("a", 1, None), ("z", 1, 4.0)], "k string, m int, v double")
    got = changes.merge_update(target(spark), source, ["k", "m"], ["v"])
    assert rows(got) == sorted([("a", 1, None), ("a", None, 2.0), ("b", 1, 3.0)], key=repr)


def test_replace_by_key(spark):
    batch = spark.createDataFrame([("a", 7, 1.5), ("a", 8, 1.5), ("c", 1, 9.0)], "k string, m int, v double")
    once = changes.replace_by_key(target(spark), batch, ["k"], ["-m"])
    assert rows(once) == sorted([("b", 1, 3.0), ("a", 8, 1.5), ("c", 1, 9.0)], key=repr)
    assert rows(changes.replace_by_key(once, batch, ["k"], ["-m"])) == rows(once)


def test_merge_statement():
    text = changes.merge_statement("t1", "v1", ["k"], ["v"], {"k": "s.k", "v": "s.v"})
    assert text == (
        "MERGE INTO t1 t USING v1 s ON t.k <=> s.k WHEN MATCHED THEN UPDATE SET t.v = s.v"
        " WHEN NOT MATCHED THEN INSERT (k, v) VALUES (s.k, s.v)"
    )


def test_grow_dictionary(spark):
    first = keys.grow_dictionary(None, spark.createDataFrame([("y",), ("x",), ("x",)], "name string"), "name", "id")
    assert rows(first, "id", "name") == [(1, "x"), (2, "y")]
    more = keys.grow_dictionary(first, spark.createDataFrame([("a",), ("x",)], "name string"), "name", "id")
    assert rows(more, "id", "name") == [(3, "a")]


def test_complete_sum_needs_every_member(spark):
    groups = spark.createDataFrame([(1, "T-L"), (2, "T"), (3, "T - Z")], "g int, c string")
    members = aggregates.group_members(groups, "g", "c")
    facts = spark.createDataFrame(
        [(1, {"T": 8.2, "L": 7.4}), (2, {"L": 1.0}), (3, None), (4, {"T": 0.1})], "s int, m map<string,double>"
    )
    want = [(1, 1, 15.6), (1, 2, 8.2), (4, 2, 0.1)]
    assert rows(aggregates.complete_sum_of_maps(facts, ["s"], "m", members, "g", "t"), "s", "g", "t") == want
    long = facts.select("s", F.explode("m").alias("member", "v"))
    assert rows(aggregates.complete_sum(long, ["s"], "member", "v", members, "g", "t"), "s", "g", "t") == want


@pytest.mark.parametrize("index_members", [200, 0])
def test_complete_sums_of_maps_against_all_groups(spark, index_members):
    rng = random.Random(5)
    subjects = [f"s{i}" for i in range(9)]
    groups = {i: rng.sample(subjects, rng.randint(1, 4)) for i in range(60)}
    students = [(i, rng.randrange(3), {s: rng.choice([None, 0.0, 1.25, 7.4]) for s in rng.sample(subjects, rng.randint(0, 7))}) for i in range(150)]
    students += students[:5]
    df = spark.createDataFrame(students, "id int, year int, m map<string,double>")
    members = aggregates.group_members(spark.createDataFrame([(g, "-".join(m)) for g, m in groups.items()], "g int, c string"), "g", "c")
    got = rows(aggregates.complete_sum_of_maps(df, ["id", "year"], "m", members, "g", "t", index_members), "id", "year", "g", "t")
    want = [(i, y, g, round(sum(m[k] for k in ks), 4)) for i, y, m in students for g, ks in groups.items() if all(m.get(k) is not None for k in ks)]
    assert got == sorted(want, key=repr) and len(want) > 500


@pytest.mark.parametrize("limit", [1000, 0])
def test_maps_by_dictionary_of_any_size(spark, limit):
    dictionary = spark.createDataFrame([("T", 1), ("T", 4), ("L", 2), (None, 9)], "s string, i int")
    texts = ["T:1,L:2", "X:3", "", None, "L:0.5,T:2", "T:1,L:2"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r["id"]: r["m"] for r in joins.maps_by_dictionary(df, "t", dictionary, "s", "i", "m", limit).collect()}
    assert got == {0: {4: 1.0, 2: 2.0}, 1: {}, 2: {}, 3: {}, 4: {2: 0.5, 4: 2.0}, 5: {4: 1.0, 2: 2.0}}


def test_no_map_is_exploded_for_its_keys(spark):
    members = aggregates.group_members(spark.createDataFrame([(1, "a-b"), (2, "c")], "g int, c string"), "g", "c")
    df = spark.createDataFrame([(1, {"a": 1.0, "b": 2.0})], "id int, m map<string,double>")
    for bound in (200, 0):
        plan = aggregates.complete_sum_of_maps(df, ["id"], "m", members, "g", "t", bound)._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.split("\n"):
            if "Generate" in line:
                assert "__map" not in line.split("[")[-1]


def decode(tags, tokens):
    """Spans by walking the tags, as plain Python."""
    out, kind, held = [], None, []
    if len(tags) != len(tokens):
        return out
    for tag, token in zip(tags, tokens, strict=True):
        inside = tag.startswith("I-") and kind is not None
        if inside and tag[2:] == kind:
            held.append(token)
            continue
        if kind is not None:
            out.append((kind, " ".join(held)))
        kind, held = (tag[2:], [token]) if tag.startswith("B-") else (None, [])
    return [*out, (kind, " ".join(held))] if kind is not None else out


@FEW
@given(st.lists(st.lists(st.sampled_from(["O", "B-A", "I-A", "B-B", "I-B", "x"]), min_size=1, max_size=12), min_size=40, max_size=80))
def test_bio_spans_against_a_walk(spark, sequences):
    data = [(i, " ".join(tags), " ".join(f"w{j}" for j in range(len(tags) + i % 5 // 4))) for i, tags in enumerate(sequences)]
    df = spark.createDataFrame(data, "id int, tags string, text string")
    for r in df.select("tags", "text", spans.bio_spans("tags", "text").alias("e")).collect():
        assert [tuple(e) for e in r["e"]] == decode(r["tags"].split(), r["text"].split())


def best_group(name, table, rules):
    """The tiers by comparing the name with every variant in order, as plain Python."""
    if len(name) < rules.min_name:
        return None
    if any(name == grp for grp, *_ in table):
        return name

    def share(variant):
        words = set(variant.split())
        return len(words & set(name.split())) / len(words) if words else 0

    def in_name(v):
        return len(v) >= rules.variant_in_name and v in name

    if rules.one_substring_tier:
        tests = [lambda v: v == name, lambda v: len(v) >= rules.variant_in_name and (v in name or name in v)]
    else:
        tests = [lambda v: v == name, in_name, lambda v: len(name) >= rules.name_in_variant and name in v]
    for passes in [*tests, lambda v: share(v) >= rules.overlap]:
        for grp, _, variant, _ in table:
            if passes(variant):
                return grp
    return None


TEXT = st.text(alphabet="ab đ", min_size=1, max_size=9).map(lambda s: " ".join(s.split())).filter(bool)


@FEW
@given(
    st.lists(st.tuples(TEXT, st.lists(TEXT, min_size=1, max_size=4, unique=True)), min_size=1, max_size=8, unique_by=lambda g: g[0]),
    st.lists(TEXT, min_size=20, max_size=60),
    st.sampled_from([aliases.ORG_RULES, aliases.MAJ_RULES]),
)
def test_alias_match_against_all_pairs(spark, groups, names, rules):
    table = [(grp, i, v, j) for i, (grp, variants) in enumerate(groups) for j, v in enumerate(variants)]
    alias_df = spark.createDataFrame(table, "grp string, key_ord int, variant string, var_ord int")
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    got = {r["id"]: r["g"] for r in aliases.alias_match(df, "name", alias_df, rules, "g").collect()}
    assert got == {i: best_group(n, table, rules) for i, n in enumerate(names)}


def test_alias_ties_go_to_the_first_in_the_dictionary(spark):
    table = [("one", 1, "abcd", 1), ("two", 2, "abcd x", 1), ("two", 2, "abcd", 2)]
    alias_df = spark.createDataFrame(table, "grp string, key_ord int, variant string, var_ord int")
    df = spark.createDataFrame([("abcd",), ("abcd x y",), ("a",), (None,)], "name string")
    got = rows(aliases.alias_match(df, "name", alias_df, aliases.ORG_RULES, "g"), "name", "g")
    assert got == sorted([("abcd", "one"), ("abcd x y", "one"), ("a", None), (None, None)], key=repr)


@pytest.mark.parametrize("rules", [aliases.ORG_RULES, aliases.MAJ_RULES])
def test_names_that_begin_alike_meet_few_variants(spark, rules):
    variants = [("g", 0, f"đại học {chr(97 + i % 26)}{i}z{i * 7} tỉnh", i) for i in range(300)]
    alias_df = spark.createDataFrame(variants, "grp string, key_ord int, variant string, var_ord int")
    tested = []
    for n in (500, 10_000):
        names = spark.createDataFrame([(f"đại học qq{i}w{i * 13}",) for i in range(n)], "name string")
        pairs = aliases.candidate_pairs(names, "name", alias_df, rules)
        tested.append(pairs.filter("kind = 'part'").count())
    assert tested[0] <= 500 and tested[1] <= 10_000


def test_org_label(spark):
    df = spark.createDataFrame([("bộ y tế",), ("đại học x",), ("khoa - y",), (None,)], "k string")
    got = [r[0] for r in df.select(aliases.org_label(F.col("k"))).collect()]
    assert got == ["tổ chức - bộ y tế", "trường - đại học x", "khoa - y", None]


def test_hash_split_is_stable_and_near_its_shares(spark):
    df = spark.range(20_000)
    one = hash_split(df, "id", {"train": 70, "validation": 15, "test": 15})
    other = hash_split(df.repartition(13), "id", {"train": 70, "validation": 15, "test": 15})
    assert rows(one) == rows(other)
    counts = {r["split"]: r["count"] for r in one.groupBy("split").count().collect()}
    assert abs(counts["train"] / 20_000 - 0.7) < 0.02 and abs(counts["test"] / 20_000 - 0.15) < 0.02


def test_evaluation_by_hand(spark):
    ner = spark.createDataFrame([("B-A I-A O B-B", "B-A I-A O B-A"), ("O O", "I-A O")], "t string, p string")
    assert tuple(evaluate_ner(ner, "t", "p").first()) == (0.333333, 0.5, 0.4, 0.666667)
    sets = spark.createDataFrame([(["a", "b"], ["a"]), (["a"], []), ([], [])], "t array<string>, p array<string>")
    assert tuple(evaluate_multilabel(sets, "t", "p").first()) == (0.333333, 0.166667, 0.222222, 0.333333)
    single = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "t string, p string")
    assert tuple(evaluate_weighted(single, "t", "p").first()) == (0.583333, 0.5, 0.458333, 0.5)
