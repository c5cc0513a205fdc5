"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.textarrays import ALNUM, lists, mixed, stretches, words

#: Hashed features: words, pairs of neighbours, and pairs with one word between.
BITS = 20
#: The model is fitted on at most this many labelled rows, those first in seeded hash order.
SAMPLE_ROWS = 12_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
CUT = 0.3
SEED = 10


class Model(NamedTuple):
    """Places and values of the weights that are not zero, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature places and the row of each, with repeats."""
    got = words(data, offsets, ALNUM)
    shift = np.uint64(64 - bits)
    places, rows = [mixed(got.hashes, 1) >> shift], [got.rows]
    for gap in (1, 2):
        if len(got.hashes) > gap:
            inside = got.rows[:-gap] == got.rows[gap:]
            pair = mixed(got.hashes[:-gap] * np.uint64(0x9E3779B97F4A7C15) + got.hashes[gap:], 1 + gap) >> shift
            places.append(pair[inside])
            rows.append(got.rows[:-gap][inside])
    return np.concatenate(places).astype(np.int64), np.concatenate(rows)


def _feature_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, values = [], []
            for _, _, data, offsets in stretches(batch.column("text")):
                place, row = features(data, offsets, bits)
                both = np.unique(row.astype(np.int64) << bits | place)
                counts.append(np.bincount(both >> bits, minlength=len(offsets) - 1))
                values.append((both & ((1 << bits) - 1)).astype(np.int32))
            if counts:
                column = lists(np.concatenate(counts), pa.array(np.concatenate(values)))
                yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("label"), column], ["rank", "label", "places"])

    return run


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, x))))


def ftrl(rows: list[tuple[int, np.ndarray]], bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """Fit on (label, feature places), in the order given, ``epochs`` times.

    Each coordinate's rate falls with its own squared gradients; L1 keeps a weight at zero
    until its evidence exceeds the penalty. The bias is a coordinate without L1.
    """
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    l1 = np.full(len(z), L1)
    l1[-1] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        over = np.maximum(np.abs(z[at]) - l1[at], 0.0)
        return -np.sign(z[at]) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for label, places in rows:
            at = np.append(places, len(z) - 1)
            w = weights(at)
            g = _sigmoid(w.sum()) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    every = weights(np.arange(len(z)))
    places = np.flatnonzero(every[:-1])
    return Model(places, every[places], float(every[-1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, trainable: Column, sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """Fit on the first ``sample_rows`` labelled ids (of those ``trainable`` allows) in hash order.

    The ids are picked from the labels alone; their texts become sorted lists of feature
    places on the executors, and only these lists reach the driver, one for each id. Null labels and ids that
    ``docs`` lacks are passed over; without any row the model says 0.5 to everything.
    """
    known = labels.select(F.col(id_col).alias("lid"), F.col(label_col).cast("int").alias("label")).filter("label is not null and lid is not null")
    known = known.filter(trainable).groupBy("lid").agg(F.max("label").alias("label"))
    picked = known.withColumn("rank", F.xxhash64(F.lit(SEED), "lid")).orderBy("rank", "lid").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(picked), F.col("id") == F.col("lid"))
    # An id may have very many rows: the text of least hash is taken where the rows are, so at most ``sample_rows`` rows are left.
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")
    chosen = met.groupBy("lid", "rank", "label").agg(least).select("rank", "label", "text")
    got = chosen.mapInArrow(_feature_rows(bits), "rank bigint, label int, places array<int>").toArrow()
    order = np.lexsort((got.column("label").to_numpy(), got.column("rank").to_numpy())) if got.num_rows else []
    places = got.column("places").combine_chunks()
    return ftrl([(int(got.column("label")[int(i)].as_py()), places[int(i)].values.to_numpy()) for i in order], bits)


def _score(model: Model, bits: int):
    size = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = np.full(size, -1, dtype=np.int64)
        place_of[model.places] = np.arange(len(model.places))
        for batch in batches:
            scores = []
            for _, _, data, offsets in stretches(batch.column("__text")):
                places, rows = features(data, offsets, bits)
                at = place_of[places]
                rows, at = rows[at >= 0], at[at >= 0]
                both = np.unique(rows * (len(model.places) + 1) + at)
                row, at = both // (len(model.places) + 1), both % (len(model.places) + 1)
                sums = np.bincount(row, weights=model.weights[at] if len(at) else None, minlength=len(offsets) - 1) + model.bias
                scores.append(1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35))))
            at = batch.schema.get_field_index("__text")
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            names = [x for x in batch.schema.names if x != "__text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(scores) if scores else [], pa.float64())], [*names, "score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None, bits: int = BITS, cut: float = CUT) -> DataFrame:
    """The columns ``carry`` (all, if None) with ``score`` (0 to 1) and ``predicted`` (1 from ``cut`` on) added.

    Each whole text is scored alone, by the weights of its distinct features; the weights
    that are not zero go out with the function. Null or empty text: the bias alone. Nulls
    elsewhere, ties and repeated rows need no rule; an empty table stays empty; columns named
    like the added ones are replaced.
    """
    keep = [c for c in (docs.columns if carry is None else carry) if c not in ("score", "predicted")]
    source = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    schema = source.drop("__text").schema.add("score", "double")
    return source.mapInArrow(_score(model, bits), schema).withColumn("predicted", (F.col("score") >= cut).cast("int"))
