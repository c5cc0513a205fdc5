"""Texts of an Arrow batch as one byte array, and words in it as arrays of hashes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in stretches of about this many bytes; a longer text is a stretch of its own.
STRETCH = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
#: Fixed random numbers: a value for each byte, a factor for each word of a run, the base of rolling hashes.
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
FACTORS = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
BASE = int(_rng.integers(1 << 40, 1 << 62)) | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
NONE = np.uint64((1 << 64) - 1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64 bits evenly."""
    h = h ^ np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def unmixed(h: np.ndarray) -> np.ndarray:
    """What ``mixed`` with seed 0 was given."""
    for factor in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(pow(factor, -1, 1 << 64))
    return h ^ (h >> np.uint64(33))


class Alphabet(NamedTuple):
    """Which bytes belong to words, and the value of each byte with A-Z taken as a-z."""

    is_word: np.ndarray
    values: np.ndarray


def alphabet(separators: list[tuple[int, int]]) -> Alphabet:
    """All bytes but the given closed ranges. Bytes from 128 on belong to characters beyond ASCII."""
    is_word = np.ones(256, dtype=bool)
    for low, high in separators:
        is_word[low : high + 1] = False
    return Alphabet(is_word, BYTE_VALUES[_LOWER])


#: Runs of ASCII letters, digits and everything beyond ASCII.
ALNUM = alphabet([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
#: Runs of anything but blanks.
NON_BLANK = alphabet([(0x20, 0x20), (0x09, 0x0D)])


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; kept for the next call."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, STRETCH + 1)
        out = []
        for base in (BASE, BASE_INVERSE):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 4 * STRETCH:
            _powers[0] = have
    return have


def stretches(column: pa.Array, limit: int = STRETCH, rows: int = 1 << 62) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, bytes and row offsets (from 0) of runs of at most ``rows`` rows. Null is empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(filled):
        last = min(first + rows, max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words(NamedTuple):
    """Hash of each word, its row in the stretch, and where each row's words begin."""

    hashes: np.ndarray
    rows: np.ndarray
    firsts: np.ndarray


def word_edges(data: np.ndarray, offsets: np.ndarray, letters: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends; words end with their row."""
    n = len(data)
    inside = letters.is_word[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, letters: Alphabet) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(letters.values[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * down[starts])


def words(data: np.ndarray, offsets: np.ndarray, letters: Alphabet) -> Words:
    if len(data) == 0:
        return Words(np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64))
    starts, stops = word_edges(data, offsets, letters)
    firsts = np.searchsorted(starts, offsets)
    return Words(word_hashes(data, starts, stops, letters), np.repeat(np.arange(len(offsets) - 1), np.diff(firsts)), firsts)


def runs_of(hashes: np.ndarray, k: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the k words from each place on (or from the places ``at`` on)."""
    factors = FACTORS if k <= len(FACTORS) else np.resize(FACTORS, k)
    if at is None:
        n = max(0, len(hashes) - k + 1)
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total += hashes[j : j + n] * factors[j]
    else:
        total = np.zeros(len(at), dtype=np.uint64)
        for j in range(k):
            total += hashes[at + j] * factors[j]
    return mixed(total, k)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each full window, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """Arrow lists of the given lengths over ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def key_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with one key, from rows that arrive sorted by it; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column(key)[-1] != batch.column(key)[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
