"""Alignment of two tokenizers: lockstep merging of token ends, links counted over the corpus.

1. A text is encoded by tokenizer A and by tokenizer B. Both cut the same bytes, so the
   running sums of token lengths are two ascending lists that end alike.
2. Lockstep merging. The texts of a stretch are lanes of one state vector, a pointer into A's and
   one into B's ends for each lane. A step moves the pointer whose token ends first, in all
   lanes at once; where both end together it emits a link, cuts the text there and moves both.
   Finished lanes are compacted away. A long text is entered at several places where
   both tokens end, each a lane of its own, so that no stretch waits for one text.
3. Pairs of ids are counted over all links. Tokens that end together are suffixes one of the
   other, so there are at most as many pairs as the tokens of both vocabularies have bytes: a bound
   that does not depend on the corpus. The counts are sent out for the scores of each text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.textarrays import lists, stretches
from lakemill.session import cut

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the pattern that splits text before the merges of byte-level BPE.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of texts that are encoded and merged together.
TOGETHER = 4 << 20
#: Tokens of A after which a text may go on as another lane, and places tried for that.
LANE, TRIES = 1024, 64
#: Distinct pairs a task holds before it passes their counts on.
PAIRS_HELD = 1 << 20

ALIGNED = "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, link_pairs array<bigint>, link_counts array<bigint>"


class Vocabulary(NamedTuple):
    """Encodes texts to arrays of ids; the bytes of each id, their number, and its number in decimal."""

    encode: object
    tokens: list[bytes]
    lengths: np.ndarray
    names: np.ndarray


def _vocabulary(encode, tokens: list[bytes]) -> Vocabulary:
    return Vocabulary(encode, tokens, np.array([len(t) for t in tokens], dtype=np.int64), np.array([str(i) for i in range(len(tokens))], dtype="S"))


def byte_level_chars() -> dict[str, int]:
    """Byte each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from 256 on in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def byte_bpe(path: str) -> Vocabulary:
    """Byte-level BPE from its JSON file, for texts with a blank put before; special tokens are plain text.

    The merges must be in the order of the ids they make: then a rank is an id.
    """
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    special = {t["id"] for t in spec["added_tokens"] if t["special"]}
    byte_of = byte_level_chars()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if i not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [spec["model"]["vocab"]["".join(m)] for m in merges]
    if spec.get("normalizer") or made != sorted(made):
        raise ValueError(f"{path}: not a byte-level BPE whose merges are in the order of their ids")
    coder = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(spec["model"]["vocab"].values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return _vocabulary(lambda texts: [coder.encode_ordinary(" " + t) for t in texts], tokens)


@cache
def piece_bpe(path: str) -> Vocabulary:
    """Pieces of a SentencePiece model, which puts the blank before a text by itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.is_byte(i)) for i in range(model.get_piece_size())]
    tokens = [bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces]
    return _vocabulary(lambda texts: model.encode(texts, num_threads=1), tokens)


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, a_from: np.ndarray, a_to: np.ndarray, b_from: np.ndarray, long: int = LANE):
    """Where lanes begin and end in A and begin in B: one a text, and in long texts more, begun after a common end."""
    per_text = np.maximum((a_to - a_from - 1) // long, 0)
    owner = np.repeat(np.arange(len(a_from)), per_text)
    at = a_from[owner] + long * (np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text) + 1)
    stop, a_more, b_more = a_to[owner], [], []
    for _ in range(TRIES):
        if not len(at):
            break
        b = np.searchsorted(ends_b, ends_a[at - 1])
        common = ends_b[b] == ends_a[at - 1]
        a_more.append(at[common])
        b_more.append(b[common] + 1)
        at, stop = at[~common] + 1, stop[~common]
        at, stop = at[at < stop], stop[at < stop]
    begins, which = np.unique(np.concatenate([a_from, *a_more]), return_index=True)
    return begins, np.concatenate([begins[1:], a_to[-1:]]), np.concatenate([b_from, *b_more])[which]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, a_from: np.ndarray, a_to: np.ndarray, b_from: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B that end together, in order, merged in all lanes at once."""
    going = a_from < a_to
    i, j, stop = a_from[going], b_from[going], a_to[going]
    links_a, links_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(i):
        end_a, end_b = ends_a[i], ends_b[j]
        both = end_a == end_b
        links_a.append(i[both])
        links_b.append(j[both])
        i = i + (end_a <= end_b)
        j = j + (end_b <= end_a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    # Both kinds of ends ascend over all texts, so sorting keeps links together.
    return np.sort(np.concatenate(links_a)), np.sort(np.concatenate(links_b))


def _with_sign(names: np.ndarray, sign: bytes) -> np.ndarray:
    return np.char.add(names, sign)


class Merged(NamedTuple):
    """What two encodings of some texts have in common."""

    a: np.ndarray
    b: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray
    a_firsts: np.ndarray
    b_firsts: np.ndarray


def merge(ids_a: list, ids_b: list, a: Vocabulary, b: Vocabulary, long: int = LANE) -> Merged:
    """Merge texts, each given by its ids in A and in B, which have equal bytes."""
    firsts = [np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64) for ids in (ids_a, ids_b)]
    flat = [np.fromiter((t for x in ids for t in x), np.int64, f[-1]) for ids, f in zip((ids_a, ids_b), firsts, strict=True)]
    ends_a, ends_b = np.cumsum(a.lengths[flat[0]]), np.cumsum(b.lengths[flat[1]])
    starts = (firsts[0][:-1], firsts[0][1:], firsts[1][:-1])
    full = starts[0] < starts[1]
    if not full.any():
        return Merged(*flat, np.empty(0, np.int64), np.empty(0, np.int64), *firsts)
    begun = lanes(ends_a, ends_b, *[s[full] for s in starts], long)
    return Merged(*flat, *lockstep(ends_a, ends_b, *begun), *firsts)


def group_strings(m: Merged, a: Vocabulary, b: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3`` for all texts, and where each text's begin."""
    ends_a, ends_b = np.zeros(len(m.a), bool), np.zeros(len(m.b), bool)
    ends_a[m.links_a] = True
    ends_b[m.links_b] = True
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    before = np.concatenate([[0], m.links_b + 1])
    width = max(a.names.itemsize, b.names.itemsize) + 1
    out = np.zeros(len(m.a) + len(m.b), dtype=f"S{width}")
    out[np.arange(len(m.a)) + before[group_a]] = np.where(ends_a, _with_sign(a.names, b"|")[m.a], _with_sign(a.names, b",")[m.a])
    out[np.arange(len(m.b)) + m.links_a[group_b] + 1] = np.where(ends_b, _with_sign(b.names, b";")[m.b], _with_sign(b.names, b",")[m.b])
    raw = out.view(np.uint8).reshape(-1, width)
    used = raw != 0
    # The sign after a text's last token goes.
    lasts = (m.a_firsts + m.b_firsts)[1:][np.diff(m.a_firsts) > 0] - 1
    used[lasts, used[lasts].sum(axis=1) - 1] = False
    sizes = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
    return raw[used], sizes[m.a_firsts + m.b_firsts]


def _align(a_path: str, b_path: str, together: int, long: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_bpe(a_path), piece_bpe(b_path)
        for batch in batches:
            for first, last, _, _ in stretches(batch.column("text"), together):
                texts = [t or "" for t in batch.column("text").slice(first, last - first).to_pylist()]
                both = []
                for text, x, y in zip(texts, a.encode(texts), b.encode(texts), strict=True):
                    whole = (" " + text).encode()
                    same = text and b"".join([a.tokens[i] for i in x]) == whole and b"".join([b.tokens[i] for i in y]) == whole
                    both.append((x, y) if same else ((), ()))
                m = merge([x for x, _ in both], [y for _, y in both], a, b, long)
                data, offsets = group_strings(m, a, b)
                groups = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
                n_links = np.diff(np.searchsorted(m.links_a, m.a_firsts))
                owner = np.repeat(np.arange(len(texts), dtype=np.int64), n_links)
                pair = m.a[m.links_a] << 32 | m.b[m.links_b]
                order = np.lexsort((pair, owner))
                owner, pair = owner[order], pair[order]
                new = np.ones(len(pair), bool)
                new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
                heads = np.flatnonzero(new)
                per_text = np.bincount(owner[heads], minlength=len(texts))
                counts = np.diff(np.concatenate([heads, [len(pair)]]))
                columns = [np.diff(m.a_firsts), np.diff(m.b_firsts), n_links, n_links]
                arrays = [batch.column("id").slice(first, last - first), *[pa.array(c, pa.int64()) for c in columns], groups.cast(pa.string())]
                arrays += [lists(per_text, pa.array(pair[heads])), lists(per_text, pa.array(counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "link_pairs", "link_counts"])

    return run


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_path: str = A_PATH,
    b_path: str = B_PATH,
    together: int = TOGETHER,
    long: int = LANE,
) -> DataFrame:
    """Tokens of both tokenizers held against each other, a row for each row of ``docs``.

    ``id``; ``n_a``, ``n_b``: tokens; ``n_groups``, ``n_links``: stretches between common ends, and
    pairs of tokens that end together (one at each common end, as no token is empty); ``groups``: their ids, ``a1,a2|b1;a3|b2,b3``;
    ``link_pairs``, ``link_counts``: distinct linked pairs of ids (A's id times 2³² plus B's) and
    how often the text links them. Both files are read where the work is done.

    Null or empty text, or one whose tokens do not give back its bytes (a tokenizer that
    normalises): no tokens, zeros, ``groups`` empty. Strings of special tokens are plain text.
    Null ids, repeated ids and repeated texts: each row has its own result. Empty table: empty
    result. Other columns are ignored. A very long text is encoded as a whole and merged in lanes.
    """
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(_align(a_path, b_path, together, long), ALIGNED)


def _added(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(pairs, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, place, counts)
    return distinct, sums


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = (np.empty(0, np.int64), np.empty(0, np.int64))

    def passed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["pair", "n"])

    for batch in batches:
        new = [batch.column(c).flatten().to_numpy() for c in ("link_pairs", "link_counts")]
        held = _added(*[np.concatenate(x) for x in zip(held, new, strict=True)])
        if len(held[0]) > PAIRS_HELD:
            yield passed_on()
            held = (held[0][:0], held[1][:0])
    yield passed_on()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (A's id times 2³² plus B's) and ``n``, the links of the corpus that hold it."""
    partly = aligned.select("link_pairs", "link_counts").mapInArrow(_count_pairs, "pair bigint, n bigint")
    return partly.groupBy("pair").agg(F.sum("n").alias("n"))


def _score(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, totals, best = table.value
        for batch in batches:
            found, counts = (batch.column(c).flatten().to_numpy() for c in ("link_pairs", "link_counts"))
            sizes = np.concatenate([[0], np.cumsum(batch.column("link_pairs").value_lengths().to_numpy())])
            place = np.searchsorted(pairs, found)
            arrays = [batch.column(i) for i in range(batch.num_columns - 2)]
            for values in (counts * best[place], counts * totals[place]):
                sums = np.concatenate([[0], np.cumsum(values)])
                arrays.append(pa.array(sums[sizes[1:]] - sums[sizes[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-2], "n_best", "count_sum"])

    return run


def score_links(aligned: DataFrame) -> DataFrame:
    """Columns of ``aligned`` but the pairs, and ``n_best`` (links whose pair is the corpus's most frequent of their B id, ties
    included) and ``count_sum`` (counts of the pairs, over links).

    ``aligned`` is written once, as it is read for the counts and for the scores. The table of
    counts goes to the driver and out again; the vocabularies bound its size (see above).
    No rows, or no links: zeros.
    """
    held = cut(aligned.select(*[c for c in aligned.columns if c not in ("link_pairs", "link_counts")], "link_pairs", "link_counts"))
    counted = pair_counts(held).orderBy("pair").toArrow()
    pairs, totals = (counted.column(c).to_numpy() for c in ("pair", "n"))
    highest = np.zeros(int((pairs & 0xFFFFFFFF).max()) + 1 if len(pairs) else 1, np.int64)
    np.maximum.at(highest, pairs & 0xFFFFFFFF, totals)
    best = (totals == highest[pairs & 0xFFFFFFFF]).astype(np.int64)
    table = held.sparkSession.sparkContext.broadcast((pairs, totals, best))
    kept = [f for f in held.schema.fields if f.name not in ("link_pairs", "link_counts")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "n_best bigint", "count_sum bigint"])
    return held.mapInArrow(_score(table), schema)
