"""Distributed text classifiers: a linear stand-in for each of the model's label heads."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalar import let
from lakemill.session import cut

FEATURES = 1 << 14


def _counted(text: str, size: int) -> list:
    return [RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"\s+"), HashingTF(inputCol="__words", outputCol="__tf", numFeatures=size)]


def _held_features(df: DataFrame, text: str, keep: list[str], size: int) -> tuple[list, DataFrame]:
    """The fitted feature stages, and ``keep`` with the features.

    Many passes read them, so word counts are worked out once and written, not the texts.
    """
    counted = _counted(text, size)
    held = df.select(text, *keep)
    for stage in counted:
        held = stage.transform(held)
    held = cut(held.select(*keep, "__tf"))
    weighed = IDF(inputCol="__tf", outputCol="__features").fit(held)
    return [*counted, weighed], weighed.transform(held).drop("__tf")


def fit_single_label(df: DataFrame, text: str, label: str, features: int = FEATURES, iterations: int = 20) -> PipelineModel:
    """Intent head: one label per row."""
    stages, ready = _held_features(df, text, [label], features)
    index = StringIndexer(inputCol=label, outputCol="__label", stringOrderType="alphabetAsc").fit(ready)
    head = LogisticRegression(featuresCol="__features", labelCol="__label", maxIter=iterations, regParam=0.01)
    return PipelineModel(stages=[index, *stages, head.fit(index.transform(ready))])


def predict_single_label(model: PipelineModel, df: DataFrame, name: str = "predicted") -> DataFrame:
    labels = F.array(*[F.lit(x) for x in model.stages[0].labels])
    # The true label is not needed to predict, so the indexer is left out.
    out = df
    for stage in model.stages[1:]:
        out = stage.transform(out)
    return out.withColumn(name, F.get(labels, F.col("prediction").cast("int"))).select(*df.columns, name)


def fit_multi_label(df: DataFrame, text: str, labels: str, names: list[str], features: int = FEATURES, iterations: int = 20):
    """Topic head: one classifier per label over shared features."""
    stages, held = _held_features(df, text, [labels], features)
    marks = {f"__is_{i}": F.array_contains(labels, n).cast("double") for i, n in enumerate(names)}
    ready = held.withColumns(marks)
    heads = [
        LogisticRegression(
            featuresCol="__features", labelCol=f"__is_{i}", maxIter=iterations, regParam=0.01,
            predictionCol=f"__p_{i}", probabilityCol=f"__prob_{i}", rawPredictionCol=f"__raw_{i}",
        ).fit(ready)
        for i in range(len(names))
    ]
    return PipelineModel(stages=stages), heads


def predict_multi_label(model, df: DataFrame, names: list[str], threshold: float = 0.5, name: str = "predicted") -> DataFrame:
    shared, heads = model
    out = shared.transform(df)
    for head in heads:
        out = head.transform(out)
    chance = [F.get(vector_to_array(f"__prob_{i}"), 1) if h.numClasses > 1 else F.col(f"__p_{i}") for i, h in enumerate(heads)]
    chosen = F.concat(
        *[F.when(c > threshold, F.array(F.lit(n))).otherwise(F.expr("cast(array() as array<string>)")) for c, n in zip(chance, names, strict=True)]
    )
    return out.withColumn(name, chosen).select(*df.columns, name)


def token_rows(df: DataFrame, key: str, tokens: str, tags: str) -> DataFrame:
    """One row per token, described by itself and its neighbours, for the tag head.

    The descriptions are made inside the row, so no token row carries the whole text.
    """

    def describe(s: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            shape = F.regexp_replace(F.regexp_replace(w, r"\p{Lu}", "X"), r"\p{Ll}", "x")
            before = F.when(i > 0, F.lower(F.get(s["w"], i - 1))).otherwise("<s>")
            after = F.lower(F.coalesce(F.get(s["w"], i + 1), F.lit("</s>")))
            parts = {"w=": F.lower(w), "shape=": shape, "prev=": before, "next=": after}
            context = F.concat_ws(" ", *[F.concat(F.lit(k), v) for k, v in parts.items()])
            return F.struct(i.alias("pos"), context.alias("context"), F.get(s["t"], i).alias("tag"))

        return F.transform(s["w"], one)

    each = let(F.struct(F.col(tokens).alias("w"), F.col(tags).alias("t")), describe)
    return df.select(key, F.explode(each).alias("__e")).select(key, "__e.*")


#: Tokens of a text that are decoded together.
PIECE = 256
NEVER = -1e9


@dataclass(frozen=True)
class TagHead:
    """A label for each token, and what each label adds to the next one: log odds of it there against anywhere.

    ``steps[i][j]`` is for label j after label i, ``first[j]`` for label j at the beginning.
    ``strict``: the corpus holds to ``may_follow``, and so do predictions.
    """

    model: PipelineModel
    labels: tuple[str, ...]
    strict: bool
    first: tuple[float, ...]
    steps: tuple[tuple[float, ...], ...]


def may_follow(tag: str, before: str | None) -> bool:
    """``I-X`` stands only after ``B-X`` or ``I-X``; anything else stands anywhere."""
    return not tag.startswith("I-") or (before is not None and before[:2] in ("B-", "I-") and before[2:] == tag[2:])


def step_weights(df: DataFrame, tags: str, labels: list[str]) -> tuple[bool, tuple[float, ...], tuple[tuple[float, ...], ...]]:
    """Whether all tags stand where they may, and weights of labels at the beginning and after each other, from how often they
    stand there (one is added to each count)."""
    pairs = F.transform(tags, lambda t, i: F.struct(F.when(i > 0, F.get(tags, i - 1)).alias("before"), t.alias("tag")))
    counted = df.select(F.explode(pairs).alias("p")).groupBy("p.before", "p.tag").agg(F.count(F.lit(1)).alias("n"))
    # A row for each pair of labels at most.
    n = {(r["before"], r["tag"]): r["n"] for r in counted.collect()}
    strict = all(may_follow(t, b) for b, t in n)
    everywhere = {t: sum(c for (_, x), c in n.items() if x == t) + 1 for t in labels}

    def weights(before: str | None) -> tuple[float, ...]:
        here = {t: n.get((before, t), 0) + 1 for t in labels}
        gain = lambda t: log(here[t] / sum(here.values())) - log(everywhere[t] / sum(everywhere.values()))
        return tuple(NEVER if strict and not may_follow(t, before) else gain(t) for t in labels)

    return strict, weights(None), tuple(weights(b) for b in labels)


def fit_tags(df: DataFrame, key: str, tokens: str, tags: str, features: int = FEATURES, iterations: int = 20) -> TagHead:
    """Tag head: a label for each token, from the token, its neighbours, and the labels next to it."""
    model = fit_single_label(token_rows(df, key, tokens, tags), "context", "tag", features, iterations)
    labels = list(model.stages[0].labels)
    return TagHead(model, tuple(labels), *step_weights(df, tags, labels))


def best_path(chances: Column, first: Column, steps: tuple[tuple[float, ...], ...]) -> Column:
    """Places of the labels of the best sequence: the sum of log chances and of step weights is highest (Viterbi).

    ``chances`` holds an array of log chances for each token, ``first`` the weights of the first one's labels.
    """
    into = F.array(*[F.array(*[F.lit(row[j]) for row in steps]) for j in range(len(steps))])
    none = F.expr("cast(array() as array<array<int>>)")
    start = F.struct(F.zip_with(F.get(chances, F.lit(0)), first, lambda e, w: e + w).alias("scores"), none.alias("backs"))

    def step(state: Column, chance: Column) -> Column:
        def reach(weights: Column, j: Column) -> Column:
            ways = F.zip_with(state["scores"], weights, lambda s, w: s + w)
            return let(ways, lambda x: F.struct((F.array_max(x) + F.get(chance, j)).alias("score"), (F.array_position(x, F.array_max(x)).cast("int") - 1).alias("back")))

        moves = F.transform(into, reach)
        return let(
            moves,
            lambda m: F.struct(
                F.transform(m, lambda x: x["score"]).alias("scores"),
                F.concat(state["backs"], F.array(F.transform(m, lambda x: x["back"]))).alias("backs"),
            ),
        )

    rest = F.slice(chances, F.lit(2), F.greatest(F.size(chances) - 1, F.lit(0)))
    end = F.aggregate(rest, start, step)

    def walk(state: Column) -> Column:
        last = F.array_position(state["scores"], F.array_max(state["scores"])).cast("int") - 1
        return F.aggregate(F.reverse(state["backs"]), F.array(last), lambda path, back: F.concat(F.array(F.get(back, F.get(path, F.lit(0)))), path))

    return let(end, walk)


def predict_tags(head: TagHead, df: DataFrame, key: str, tokens: str, name: str = "predicted", piece: int = PIECE) -> DataFrame:
    """(key, tag string) per row; a row's tags are put together again, so ``key`` must identify it.

    Labels are chosen together, up to ``piece`` tokens at a time, so that a long text is no
    burden. In a strict head a span that goes on into a piece where it cannot stand begins anew there.
    """
    blank = F.transform(F.col(tokens), lambda _: F.lit(None).cast("string"))
    out = token_rows(df.withColumn("__none", blank), key, tokens, "__none")
    for stage in head.model.stages[1:]:
        out = stage.transform(out)
    chance = F.transform(vector_to_array("probability"), lambda p: F.log(F.greatest(p, F.lit(1e-12))))
    part = F.floor(F.col("pos") / piece).cast("int").alias("part")
    held = out.groupBy(key, part).agg(F.array_sort(F.collect_list(F.struct("pos", chance.alias("chance")))).alias("__ordered"))
    free, labels = F.array(*[F.lit(0.0)] * len(head.labels)), F.array(*[F.lit(x) for x in head.labels])
    first = F.when(F.col("part") == 0, F.array(*[F.lit(w) for w in head.first])).otherwise(free)
    chances = held.select(key, "part", F.transform("__ordered", lambda x: x["chance"]).alias("__chances"), first.alias("__first"))
    places = chances.select(key, "part", best_path(F.col("__chances"), F.col("__first"), head.steps).alias("__path"))
    tags = places.select(key, "part", F.transform("__path", lambda i: F.get(labels, i)).alias("__tags"))
    joined = tags.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("part", "__tags"))).alias("__parts"))
    whole = joined.select(key, F.flatten(F.transform("__parts", lambda p: p["__tags"])).alias("__tags"))

    def mended(t: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("__tags", i - 1)).otherwise("O")
        stands = ~t.startswith("I-") | (before.rlike("^[BI]-") & (F.substring(before, 3, 1 << 30) == F.substring(t, 3, 1 << 30)))
        return F.when(stands, t).otherwise(F.concat(F.lit("B-"), F.substring(t, 3, 1 << 30)))

    return whole.select(key, F.array_join(F.transform("__tags", mended) if head.strict else F.col("__tags"), " ").alias(name))
