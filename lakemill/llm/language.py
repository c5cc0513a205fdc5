"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed into
phrases, each the longest match with the language's text, and the language that needs the
fewest wins: phrases × log₂(training letters) / letters estimates the cross entropy.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.session import bound_batches

UNKNOWN = "und"
#: Per language, the model sees at most this many rows (first in seeded hash order), this many characters of each, and this many in all.
SAMPLE_ROWS = 64
EXCERPT_CHARS = 2_000
LANGUAGE_CHARS = 30_000
#: All automata together are built from at most this many characters, so many languages get less each. That bounds
#: what is broadcast: at most two states a character, one number per letter code and state (some 490 MB with 255 codes,
#: 20 to 40 MB with the letters of four European languages).
ALL_CHARS = 240_000
#: Letters with codes of their own; rarer ones share code 1, everything else is code 0.
LETTERS = 253
#: Phrases end after this many symbols, in texts of any length, so that stretches of a text can be parsed side by side.
STRETCH = 2_048
BATCH_CHARS = 2 << 20
SEED = 1


class Model(NamedTuple):
    """Languages in order, code of each code point, and all automata in one transition table.

    ``table[state * codes + code]`` is twice the offset of the next state's row, plus one
    where a new phrase begins. ``roots`` are the offsets at which languages begin.
    """

    langs: list[str]
    codes: np.ndarray
    table: np.ndarray
    roots: np.ndarray
    scale: np.ndarray


def symbols(text: str, codes: np.ndarray) -> np.ndarray:
    """Codes of a lower-cased text, with runs of non-letters as one 0."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    out = codes[points]
    keep = out != 0
    keep[1:] |= out[:-1] != 0
    return out[keep]


def automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in sequence:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


def build(samples: dict[str, list[str]], language_chars: int = LANGUAGE_CHARS, all_chars: int = ALL_CHARS) -> Model:
    """Model of labelled texts by language; languages without a letter are left out."""
    lowered = {lang: [t.lower() for t in texts] for lang, texts in samples.items()}
    counts = Counter(c for texts in lowered.values() for t in texts for c in t if c.isalpha())
    frequent = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]]
    codes = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=np.uint8, count=0x110000)
    for i, c in enumerate(frequent):
        codes[ord(c)] = 2 + i
    n_codes = 2 + len(frequent)
    each = min(language_chars, all_chars // max(1, len(samples)))
    langs, tables, roots, scale, at = [], [], [], [], 0
    for lang in sorted(lowered):
        text = symbols(" ".join(lowered[lang]), codes)[:each]
        if not (text > 0).any():
            continue
        go = automaton(text.tolist())
        root = np.zeros(n_codes, dtype=np.int32)
        root[list(go[0])] = list(go[0].values())
        # A symbol that does not go on begins a new phrase from the root; so does any symbol at the root.
        table = np.tile((at + root * n_codes) * 2 + 1, (len(go), 1))
        for state, moves in enumerate(go[1:], 1):
            table[state, list(moves)] = (at + np.fromiter(moves.values(), np.int32) * n_codes) * 2
        langs.append(lang)
        tables.append(table.reshape(-1))
        roots.append(at)
        scale.append(math.log2(1 + len(text)))
        at += table.size
    # Offsets fit into 32 bits by the bound on all characters.
    table = np.concatenate(tables) if tables else np.empty(0, np.int32)
    return Model(langs, codes, table, np.array(roots, np.int64), np.array(scale))


def count_phrases(lanes: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Phrases of each lane (rows of ``lanes`` are steps; lanes are sorted by falling length) in each language."""
    kind = model.table.dtype
    state = np.repeat(model.roots.astype(kind)[:, None], lanes.shape[1], axis=1)
    phrases = np.zeros(state.shape, dtype=np.int32)
    active = np.searchsorted(-lengths, -np.arange(lanes.shape[0]), side="left")
    for step in range(lanes.shape[0]):
        n = active[step]
        value = model.table.take(state[:, :n] + lanes[step, :n])
        phrases[:, :n] += value & 1
        state[:, :n] = value >> 1
    return phrases


def parse(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each text, and its phrases in each language."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), dtype=np.uint32)
    ends = np.cumsum([len(t) for t in lowered])
    codes = model.codes[points]
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    first = np.concatenate([[0], ends[:-1]])
    first = first[first < len(codes)]
    keep[first] = codes[first] != 0
    kept = np.concatenate([[0], np.cumsum(keep)])
    sums = np.concatenate([[0], np.cumsum(codes != 0)])
    bounds = np.concatenate([[0], ends])
    letters = np.diff(sums[bounds])
    starts, sizes = kept[bounds[:-1]], np.diff(kept[bounds])
    codes = codes[keep]
    n_lanes = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(texts)), n_lanes)
    nth = np.arange(n_lanes.sum()) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
    begin = starts[owner] + nth * STRETCH
    length = np.minimum(sizes[owner] - nth * STRETCH, STRETCH)
    order = np.argsort(-length, kind="stable")
    owner, begin, length = owner[order], begin[order], length[order]
    phrases = np.zeros((len(model.langs), len(texts)), dtype=np.int64)
    if len(order):
        steps = np.arange(length[0])
        at = np.minimum(begin[None, :] + steps[:, None], len(codes) - 1)
        counted = count_phrases(codes[at].astype(model.table.dtype), length, model)
        for i in range(len(model.langs)):
            phrases[i] = np.bincount(owner, weights=counted[i], minlength=len(texts)).astype(np.int64)
    return letters, phrases


def judge(texts: list[str], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and phrases per letter of each text.

    Score: how much shorter, as a part of the second best, the best parse is. A text without
    letters, or a model without languages: ``und`` and 0. Ties go to the first in order.
    """
    langs, scores, density = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    if not model.langs or not texts:
        return langs, scores, density
    letters, phrases = parse(texts, model)
    cost = phrases * model.scale[:, None]
    best = cost.argmin(axis=0)
    for i in np.flatnonzero(letters):
        langs[i] = model.langs[best[i]]
    ordered = np.sort(cost, axis=0)
    second = ordered[1] if len(ordered) > 1 else ordered[0] * np.inf
    has = letters > 0
    scores[has] = 1.0 - ordered[0][has] / np.maximum(second[has], 1e-9)
    density[has] = phrases[best[has], has.nonzero()[0]] / letters[has]
    return langs, np.clip(scores, 0.0, 1.0), density


def fit(docs: DataFrame, trainable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, excerpt: int = EXCERPT_CHARS) -> Model:
    """Model from a bounded sample of the labelled rows that ``trainable`` allows.

    Per language, the ``sample_rows`` rows first in seeded hash order, found from ids and
    labels alone (each partition keeps no more than that many per language before the
    shuffle), and ``excerpt`` characters of each. Of an id's rows, or of those without one, the
    text of least hash counts, so no more than ``sample_rows`` rows a language reach the driver.
    """
    labelled = docs.filter(trainable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = Window.partitionBy("lang").orderBy("rank", "lid")
    ids = labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("lid"), F.xxhash64(F.lit(SEED), id_col).alias("rank"))
    picked = ids.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample_rows).select("lid", F.col("lang").alias("as"), "rank").distinct()
    excerpts = labelled.join(F.broadcast(picked), F.col(id_col).eqNullSafe(F.col("lid")) & (F.col(lang_col) == F.col("as")))
    # An id may have very many rows: the text of least hash is taken where the rows are.
    start = F.struct(F.xxhash64(text_col).alias("h"), F.substring(text_col, 1, excerpt).alias("t"))
    single = excerpts.groupBy("as", "rank", "lid").agg(F.min(start)["t"].alias("t"))
    rows = single.select("as", "rank", "t").orderBy("as", "rank", "t").collect()
    samples: dict[str, list[str]] = {}
    for r in rows:
        samples.setdefault(r["as"], []).append(r["t"])
    return build(samples)


def identify(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all, if None) with ``lang_pred``, ``score`` and ``phrases_per_letter`` added.

    Each whole text is judged alone; long ones are parsed in stretches of fixed length, as
    all are. Null, empty or letterless text: ``und``, 0, 0. Ties: the first language in
    order. Nulls elsewhere and repeated rows need no rule; an empty table stays empty;
    columns named like the added ones are replaced.
    """
    added = ["lang_pred", "score", "phrases_per_letter"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in added]
    # A text that is carried anyway goes out once.
    source = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    place = source.columns.index(text_col)
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            begin, size, column = 0, 0, batch.column(place)
            for i, n in enumerate(pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)):
                size += n
                if size < BATCH_CHARS and i + 1 < len(column):
                    continue
                part = batch.slice(begin, i + 1 - begin)
                langs, scores, density = judge([t or "" for t in part.column(place).to_pylist()], own)
                new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(density, pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *new], [*keep, *added])
                begin, size = i + 1, 0

    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("phrases_per_letter", "double")
    return source.mapInArrow(run, schema)
