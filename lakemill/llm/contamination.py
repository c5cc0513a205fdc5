"""Benchmark decontamination by winnowed k-gram fingerprints.

The minimum k-gram hash of every sliding window of w k-grams is kept, for test items and
for training texts alike, so any shared span of w + k − 1 = 13 words shares a fingerprint.
Fingerprints of a text that an item has too are extended: each of the w windows of 13 words
around one is looked up among the items' windows and compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.textarrays import ALNUM, NONE, lists, runs_of, sliding, stretches, words

SPAN = 13
GRAM = 5
#: Test items are indexed in blocks of at most about this much text, so that what is broadcast has a bound: some 20
#: bytes of index for each byte of text, as a window spells out its words.
BLOCK_BYTES = 4 << 20
ADDED = "n_words bigint, hits array<struct<s:int,e:int>>, item_ids array<string>"


class Profile(NamedTuple):
    """Windows of one length: fingerprints, windows and which items hold each."""

    length: int
    gram: int
    prints: np.ndarray
    likely: np.ndarray
    windows: np.ndarray
    spelled: np.ndarray
    firsts: np.ndarray
    items: np.ndarray


def _likely(prints: np.ndarray) -> np.ndarray:
    """A bit for the low 20 bits of each fingerprint: most other hashes are told apart by one look."""
    bits = np.zeros(1 << 20, dtype=bool)
    bits[(prints & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return bits


def build_index(texts: list[str], span: int = SPAN, gram: int = GRAM) -> list[Profile]:
    """Profiles of the items ``texts``, numbered from 0: one for ``span`` words, one for each shorter length that occurs."""
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    hashes: list[np.ndarray] = []
    column = pa.array(texts, pa.string())
    for first, _, data, offsets in stretches(column):
        got = words(data, offsets, ALNUM)
        for row in range(len(offsets) - 1):
            own = got.hashes[got.firsts[row] : got.firsts[row + 1]]
            if len(own):
                length = min(span, len(own))
                found.setdefault(length, []).append((np.full(len(own) - length + 1, first + row), np.lib.stride_tricks.sliding_window_view(own, length)))
                hashes.append(own)
    profiles = []
    for length, parts in sorted(found.items()):
        items = np.concatenate([p[0] for p in parts])
        spelled = np.concatenate([p[1] for p in parts])
        k = min(gram, length)
        keys = runs_of(spelled.reshape(-1), length, np.arange(len(spelled)) * length)
        grams = np.stack([runs_of(spelled.reshape(-1), k, np.arange(len(spelled)) * length + j) for j in range(length - k + 1)])
        order = np.lexsort((items, keys))
        keys, items, spelled = keys[order], items[order], spelled[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        firsts = np.append(np.flatnonzero(new), len(keys))
        prints = np.unique(grams.min(axis=0))
        profiles.append(Profile(length, k, prints, _likely(prints), keys[new], spelled[new], firsts, items))
    return profiles


def _present(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted ``among``, or −1."""
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return np.where(among[at] == values, at, -1)


def _matches(hashes: np.ndarray, rows: np.ndarray, p: Profile) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window of the profile begins, and which window it is."""
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(hashes) < p.length:
        return nothing
    grams = runs_of(hashes, p.gram)
    width = p.length - p.gram + 1
    grams = np.where(rows[: len(grams)] == rows[p.gram - 1 :], grams, NONE)
    # A place is kept if it is the least of some window: the largest of the least around it.
    least = sliding(grams, width, np.minimum)
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    kept = (sliding(around, width, np.maximum) == grams) & p.likely[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)]
    places = np.flatnonzero(kept)
    places = places[_present(grams[places], p.prints) >= 0]
    if not len(places):
        return nothing
    starts = np.unique((places[:, None] - np.arange(width)).reshape(-1))
    starts = starts[(starts >= 0) & (starts + p.length <= len(hashes))]
    starts = starts[rows[starts] == rows[starts + p.length - 1]]
    which = _present(runs_of(hashes, p.length, starts), p.windows)
    starts, which = starts[which >= 0], which[which >= 0]
    same = (hashes[starts[:, None] + np.arange(p.length)] == p.spelled[which]).all(axis=1)
    return starts[same], which[same]


def _scan(column: pa.Array, profiles: list[Profile], names: np.ndarray) -> list[pa.Array]:
    n_words, spans, n_spans, items, n_items = [], [], [], [], []
    for _, _, data, offsets in stretches(column):
        got = words(data, offsets, ALNUM)
        n_rows = len(offsets) - 1
        change = np.zeros(len(got.hashes) + 1, dtype=np.int32)
        pairs = [np.empty((0, 2), np.int64)]
        for p in profiles:
            starts, which = _matches(got.hashes, got.rows, p)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + p.length, -1)
            seen = np.unique(np.stack([got.rows[starts], which], axis=1), axis=0)
            counts = p.firsts[seen[:, 1] + 1] - p.firsts[seen[:, 1]]
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            held = p.items[np.repeat(p.firsts[seen[:, 1]], counts) + offset]
            pairs.append(np.stack([np.repeat(seen[:, 0], counts), held], axis=1))
        hit = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
        # A run of hit words ends with its document.
        edge = np.zeros(len(hit) - 1, dtype=bool)
        edge[got.firsts[(got.firsts > 0) & (got.firsts < len(got.hashes))]] = True
        begin = np.flatnonzero(hit[1:] & (~hit[:-1] | edge))
        end = np.flatnonzero(hit[:-1] & (~hit[1:] | edge))
        row = got.rows[begin]
        spans.append(np.stack([begin - got.firsts[row], end - got.firsts[row]], axis=1))
        n_spans.append(np.bincount(row, minlength=n_rows))
        both = np.unique(np.concatenate(pairs), axis=0)
        items.append(both[:, 1])
        n_items.append(np.bincount(both[:, 0], minlength=n_rows))
        n_words.append(np.diff(got.firsts))
    if not n_words:
        return [pa.array([], T_) for T_ in (pa.int64(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])), pa.list_(pa.string()))]
    both = np.concatenate(spans).astype(np.int32)
    ranges = pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["s", "e"])
    found = pa.array(names, pa.string()).take(pa.array(np.concatenate(items)))
    return [pa.array(np.concatenate(n_words)), lists(np.concatenate(n_spans), ranges), lists(np.concatenate(n_items), found)]


def _covered(hits: Column) -> Column:
    """How many places ranges cover together."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto"))

    def add(acc: Column, x: Column) -> Column:
        more = F.greatest(x["e"] - F.greatest(x["s"], acc["upto"]), F.lit(0))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["upto"], x["e"]).alias("upto"))

    return F.aggregate(F.array_sort(hits), start, add, lambda acc: acc["n"])


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    carry: list[str] | None = None,
    item_col: str = "item_id",
    item_text_col: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns ``carry`` (all, if None) with n_words, n_hit, item_ids and ``contaminated`` added.

    A word is hit if it lies in an occurrence of a window, which is ``span`` consecutive
    words of an item or all words of a shorter one. A text is contaminated if at least a
    twentieth of its words, and at least one, is hit. ``item_ids`` lists, as sorted strings,
    the items with occurring windows.

    Test items are cut into blocks of bounded text (a single longer item is a block). One
    block is the common case: its index is broadcast and texts are passed once, without a
    shuffle. With more blocks each is a pass of its own, and the spans that the passes
    found are gathered per text by a grouping.

    Null or empty text has no words and is never contaminated. Null or wordless items match
    nothing; items that repeat an id or a text are all listed, each id once. Null ids,
    repeated rows and ties need no rule: every row is judged alone. Empty tables are fine.
    Columns named like the added ones are replaced.
    """
    added = ["n_words", "n_hit", "item_ids", "contaminated", "hits"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in added]
    source = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    texts = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).filter(F.col("text").isNotNull())
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n_blocks = max(1, -(-size // block_bytes))
    kept_schema = T.StructType([f for f in source.schema.fields if f.name != "__text"])
    schema = T.StructType(kept_schema.fields + T.StructType.fromDDL(ADDED).fields)
    spark = docs.sparkSession

    def one_pass(rows: DataFrame, block: int, out: T.StructType) -> DataFrame:
        own = texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block).collect()
        index = spark.sparkContext.broadcast((build_index([r["text"] for r in own], span, gram), np.array([r["item"] for r in own], dtype=object)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            profiles, names = index.value
            for batch in batches:
                at = batch.schema.get_field_index("__text")
                kept = [c for i, c in enumerate(batch.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*kept, *_scan(batch.column(at), profiles, names)], out.fieldNames())

        return rows.mapInArrow(run, out)

    if n_blocks == 1:
        marked = one_pass(source, 0, schema)
    else:
        # Equal texts have equal findings, so texts are known by a 128-bit hash and passed without their other columns.
        key = F.struct(F.xxhash64("__text").alias("a"), F.xxhash64(F.lit("b"), F.col("__text")).alias("b"))
        bare = source.select(key.alias("__key"), "__text")
        bare_schema = T.StructType([f for f in bare.schema.fields if f.name == "__key"] + T.StructType.fromDDL(ADDED).fields)
        passes = one_pass(bare, 0, bare_schema)
        for block in range(1, n_blocks):
            passes = passes.unionByName(one_pass(bare, block, bare_schema))
        per_block = passes.distinct()
        gathered = per_block.groupBy("__key").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("item_ids")).alias("item_ids")
        )
        marked = source.withColumn("__key", key).join(gathered, "__key").drop("__key", "__text")
    n_hit = _covered(F.col("hits"))
    return (
        marked.withColumn("n_hit", n_hit)
        .withColumn("item_ids", F.array_sort(F.array_distinct("item_ids")))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words")))
        .select(*keep, "n_words", "n_hit", "item_ids", "contaminated", "hits")
    )
