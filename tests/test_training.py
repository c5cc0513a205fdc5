"""The linear heads learn what a rule makes plain."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakemill.functions.scalar import words
from lakemill.operators import training
from lakemill.operators.evaluation import evaluate_ner

TEXTS = ["học phí cao quá", "điểm chuẩn cao", "học phí thấp", "điểm chuẩn thấp quá", "học phí và điểm chuẩn"] * 8


def test_single_label(spark):
    df = spark.createDataFrame([(i, t, "fee" if "phí" in t else "score") for i, t in enumerate(TEXTS)], "id int, text string, label string")
    model = training.fit_single_label(df, "text", "label", features=64)
    found = training.predict_single_label(model, df.drop("label"))
    assert found.join(df, "id").filter("predicted <> label").count() == 0


def test_multi_label(spark):
    names = ["fee", "score"]
    df = spark.createDataFrame([(i, t, [n for n, w in (("fee", "phí"), ("score", "chuẩn")) if w in t]) for i, t in enumerate(TEXTS)], "id int, text string, labels array<string>")
    found = training.predict_multi_label(training.fit_multi_label(df, "text", "labels", names, features=64), df, names)
    assert found.filter(F.array_sort("predicted") != F.array_sort("labels")).count() == 0


def test_tags(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string").select(
        "id", words("text").alias("tokens"), F.transform(words("text"), lambda w: F.when(w == "phí", "B-FEE").otherwise("O")).alias("tags")
    )
    rows = training.token_rows(df, "id", "tokens", "tags")
    assert rows.filter("id = 0 and pos = 1").first()["context"] == "w=phí shape=xxx prev=học next=cao"
    model = training.fit_tags(df, "id", "tokens", "tags", features=64)
    found = training.predict_tags(model, df, "id", "tokens").join(df, "id")
    assert found.filter(F.col("predicted") != F.array_join("tags", " ")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_best_path_against_all_paths(spark, seed):
    rng = random.Random(seed)
    k, long = 3, 5
    steps = tuple(tuple(rng.choice([0.5, -1.0, -2.5, training.NEVER]) for _ in range(k)) for _ in range(k))
    data = [(n, [[rng.uniform(-3, 0) for _ in range(k)] for _ in range(n)], [rng.uniform(-1, 1) for _ in range(k)]) for n in range(1, long + 1)]
    df = spark.createDataFrame(data, "n int, chances array<array<double>>, first array<double>")
    got = {r["n"]: r["path"] for r in df.select("n", training.best_path(F.col("chances"), F.col("first"), steps).alias("path")).collect()}
    for n, chances, first in data:
        worth = lambda p: first[p[0]] + sum(chances[i][x] for i, x in enumerate(p)) + sum(steps[a][b] for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731
        assert worth(got[n]) == pytest.approx(max(worth(p) for p in itertools.product(range(k), repeat=n)))


def spans_in_doubt(n, seed):
    """Names of two kinds whose later words tell nothing of their kind."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        tokens, tags = [], []
        for _ in range(rng.randint(1, 4)):
            for _ in range(rng.randint(1, 3)):
                tokens.append(rng.choice(["a", "b", "c"]))
                tags.append("O")
            kind = rng.choice(["ORG", "MAJ"])
            tokens.append({"ORG": "school", "MAJ": "study"}[kind])
            tags.append(f"B-{kind}")
            for _ in range(rng.randint(1, 5)):
                tokens.append(rng.choice(["x", "y"]))
                tags.append(f"I-{kind}")
        out.append((i, tokens, tags))
    return out


@pytest.mark.parametrize("piece", [256, 7])
def test_tags_chosen_together_beat_tags_chosen_one_by_one(spark, piece):
    schema = "id int, tokens array<string>, tags array<string>"
    train, held_out = (spark.createDataFrame(spans_in_doubt(n, s), schema) for n, s in ((150, 1), (80, 2)))
    head = training.fit_tags(train, "id", "tokens", "tags", features=1 << 10)
    together = training.predict_tags(head, held_out, "id", "tokens", piece=piece).join(held_out, "id").withColumn("truth", F.array_join("tags", " "))
    alone = training.predict_single_label(head.model, training.token_rows(held_out, "id", "tokens", "tags"), "p")
    single = alone.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "p"))), lambda x: x["p"]), " ").alias("predicted")).join(
        together.select("id", "truth"), "id"
    )
    f1 = [evaluate_ner(d, "truth", "predicted").first()["f1"] for d in (together, single)]
    assert f1[0] > f1[1] + 0.1
    for r in together.collect():
        tags = r["predicted"].split(" ")
        assert len(tags) == len(r["tokens"])
        assert all(training.may_follow(t, b) for b, t in zip([None, *tags], tags, strict=False))
