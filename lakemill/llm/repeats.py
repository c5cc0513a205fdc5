"""Removal of long repeats with run-length compressed Burrows-Wheeler indexes.

A byte goes if it lies in a string of ``span`` bytes that also starts earlier in the corpus.
One index over the whole corpus would not be distributable, so text is first routed to where
it can match, and only what is still open is indexed:

1. Anchors. In every window of ``span`` bytes the least hash of the 32-byte strings in it is
   its anchor; equal windows have equal anchors at equal offsets. Consecutive windows with
   one anchor make a stretch of text. Stretches, known by hashes of the anchor and of the
   whole, are dealt by anchor; all but the first of equal ones are repeats as a whole. Each
   batch keeps only the first of its equal stretches, so copies do not pile up in a task.
   A document given in several rows is judged once: equal places of it are one place.
2. Index. Where an anchor has several different stretches, one text of each is sent, dealt
   by anchor again. A task sorts the suffixes of such texts, forms their Burrows-Wheeler
   transform, compresses it to runs, and samples positions at the ends of runs and the first
   position of each interval of suffixes that share ``span`` bytes. Each text is then
   streamed backwards through the runs; a place whose interval begins earlier is a repeat.
   An anchor with very many stretches would make a hot group: its windows are dealt by
   their own hashes instead, again only the first of each batch.
3. Spans found by all of these are dealt by document, packed, gathered there into one row
   per document, and cut out of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.textarrays import BYTE_VALUES, mixed, powers, sliding, stretches
from lakemill.session import cut

SPAN = 100
GRAM = 32
#: Stretches of one anchor from which on its windows are dealt one by one.
HOT = 4_096
#: Bytes of text in one index.
INDEX_BYTES = 1 << 20
#: Bytes worked on at a time.
PIECE = 1 << 20
_LOWEST = -(1 << 63)
_PLACE_BITS = np.uint64(24)
_PLACES = np.uint64((1 << 24) - 1)

#: A document is an id and 64 bits of its text's hash, as null and repeated ids have many texts.
RUN = (("h", "u8"), ("u", "u8"), ("id", "i8"), ("tag", "i8"), ("lo", "i4"), ("n", "u2"))
REP = (("h", "u8"), ("id", "i8"), ("tag", "i8"), ("lo", "i4"), ("n", "u2"))
WINDOW = (("a", "u8"), ("b", "u8"), ("id", "i8"), ("tag", "i8"), ("lo", "i4"))
FOUND = (("id", "i8"), ("tag", "i8"), ("lo", "i4"), ("hi", "i4"))
STILL_OPEN = (("id", "i8"), ("tag", "i8"), ("h", "u8"), ("lo", "i4"), ("n", "u2"), ("hot", "u1"))
#: Per document, row by row: spans, and stretches still open.
SPANS = np.dtype([("lo", "<i4"), ("hi", "<i4")])
OPEN = np.dtype([("h", "<u8"), ("lo", "<i4"), ("n", "<u2"), ("hot", "u1")])
PART = "shard int, kind string, blob binary"
DOC = "key bigint, tag bigint, spans binary, reps binary"


def pack(fields, columns: list[np.ndarray]) -> bytes:
    return b"".join(c.astype(t, copy=False).tobytes() for (_, t), c in zip(fields, columns, strict=True))


def unpack(fields, blobs: list[bytes]) -> list[np.ndarray]:
    """Columns of all blobs, one after the other."""
    out = [[np.empty(0, t)] for _, t in fields]
    width = sum(np.dtype(t).itemsize for _, t in fields)
    for blob in blobs:
        n, at = len(blob) // width, 0
        for column, (_, t) in zip(out, fields, strict=True):
            column.append(np.frombuffer(blob, dtype=t, count=n, offset=at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(c) for c in out]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards by hash. Anchors are least hashes and so lie low: they are mixed again before."""
    hashes = mixed(hashes, 37)
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def doc_shard(ids: np.ndarray, tags: np.ndarray, shards: int) -> np.ndarray:
    ids, tags = (c.astype(np.int64, copy=False).view(np.uint64) for c in (ids, tags))
    return shard_of(mixed(ids, 23) ^ mixed(tags, 41), shards)


def dealt(kind: str, shard: np.ndarray, fields, columns: list[np.ndarray]) -> list[tuple[int, str, bytes]]:
    """One packed blob for each shard that has rows; rows keep their order."""
    if not len(shard):
        return []
    order = np.argsort(shard, kind="stable")
    shard, columns = shard[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    ends = np.append(cuts[1:], len(shard))
    return [(int(shard[a]), kind, pack(fields, [c[a:b] for c in columns])) for a, b in zip(cuts, ends, strict=True)]


def _distinct(columns: list[np.ndarray]) -> np.ndarray:
    """Places of the distinct rows of some columns, in the rows' order. A row of documents given twice is one place."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order[new]


def _part_batch(parts: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    arrays = [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.string()), pa.array([p[2] for p in parts], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "kind", "blob"])


def anchored(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Stretches of a byte array that holds texts at ``offsets``: first window, windows, anchor hash, hash of the whole.

    Windows lie within one text. Long arrays are worked on in pieces; a stretch cut by a
    piece's end is two stretches with one anchor, which later steps compare all the same.
    """
    found = []
    sizes = np.diff(offsets)
    for begin in range(0, max(0, len(data) - span + 1), PIECE):
        piece = data[begin : begin + PIECE + span - 1]
        n = len(piece)
        up, down = powers(n + 1)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[piece] * up[:n], out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        ranked = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding(ranked, span - gram + 1, np.minimum) & _PLACES).astype(np.int64)
        # Places where a whole window fits into its text.
        change = np.zeros(len(anchor) + 1, dtype=np.int32)
        fits = sizes >= span
        np.add.at(change, np.clip(offsets[:-1][fits] - begin, 0, len(anchor)), 1)
        np.add.at(change, np.clip(offsets[:-1][fits] + sizes[fits] - span + 1 - begin, 0, len(anchor)), -1)
        inside = np.cumsum(change[:-1]) > 0
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
        last = inside.copy()
        last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
        lo, hi = np.flatnonzero(new), np.flatnonzero(last)
        whole = mixed((sums[hi + span] - sums[lo]) * down[lo], 29) ^ (anchor[lo] - lo).astype(np.uint64)
        found.append((lo + begin, hi - lo + 1, grams[anchor[lo]], whole))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _anchors(shards: int, span: int):
    """Per batch: the first of equal stretches by anchor, and the spans of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tag = batch.column("key").to_numpy(), batch.column("tag").to_numpy()
            order = _distinct([key, tag])
            key, tag, texts = key[order], tag[order], batch.column("text").take(pa.array(order))
            got = []
            for first, _, data, offsets in stretches(texts, PIECE):
                lo, n, h, u = anchored(data, offsets, span)
                row = np.searchsorted(offsets, lo, side="right") - 1
                got.append((h, u, key[first + row], tag[first + row], lo - offsets[row], n))
            if not got:
                continue
            h, u, ids, tags, lo, n = (np.concatenate(c) for c in zip(*got, strict=True))
            both = mixed(h ^ (u << np.uint64(1) | u >> np.uint64(63)), 31)
            near = np.argsort(both, kind="stable")
            again = np.zeros(len(both), dtype=bool)
            again[near[1:]] = (h[near[1:]] == h[near[:-1]]) & (u[near[1:]] == u[near[:-1]])
            fresh = ~again
            parts = dealt("run", shard_of(h[fresh], shards), RUN, [c[fresh] for c in (h, u, ids, tags, lo, n)])
            parts += dealt("span", doc_shard(ids[again], tags[again], shards), FOUND, [c[again] for c in (ids, tags, lo, lo + n - 1 + span)])
            if parts:
                yield _part_batch(parts)

    return run


def _binary(rows: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of rows of the given lengths as binary values."""
    ends = np.append(0, np.cumsum(counts)) * rows.dtype.itemsize
    kind = pa.large_binary()
    column = pa.Array.from_buffers(kind, len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(rows.tobytes())])
    return column.cast(pa.binary())


def _by_document(found: list[np.ndarray], opened: list[np.ndarray]) -> pa.RecordBatch:
    """Spans (id, tag, lo, hi) and open stretches (id, tag, h, lo, n, hot) as one row per document."""
    ids, tags = np.concatenate([found[0], opened[0]]), np.concatenate([found[1], opened[1]])
    order = np.lexsort((tags, ids))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (tags[order][1:] != tags[order][:-1])
    doc = np.empty(len(order), dtype=np.int64)
    doc[order] = np.cumsum(new) - 1
    n_docs, n_spans = int(new.sum()), len(found[0])
    columns = [pa.array(ids[order][new]), pa.array(tags[order][new])]
    for own, kind, values in ((doc[:n_spans], SPANS, found[2:]), (doc[n_spans:], OPEN, opened[2:])):
        by = np.argsort(own, kind="stable")
        rows = np.empty(len(own), dtype=kind)
        for name, column in zip(kind.names, values, strict=True):
            rows[name] = column[by]
        columns.append(_binary(rows, np.bincount(own, minlength=n_docs)))
    return pa.RecordBatch.from_arrays(columns, ["key", "tag", "spans", "reps"])


def _to_documents(shards: int, found: list[np.ndarray], opened: list[np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    """Spans, and open stretches, packed for the shards of their documents."""
    parts = dealt("found", doc_shard(found[0], found[1], shards), FOUND, found)
    if opened is not None:
        parts += dealt("open", doc_shard(opened[0], opened[1], shards), STILL_OPEN, opened)
    if parts:
        yield _part_batch(parts)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of a partition, which has all of a shard; documents with open stretches have ``reps``."""
    blobs = _blobs(batches)
    if blobs:
        yield _by_document(unpack(FOUND, blobs.get("found", [])), unpack(STILL_OPEN, blobs.get("open", [])))


def pairs(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sorted spans with those that touch or overlap joined, as rows (start, end)."""
    if not len(lo):
        return np.empty((0, 2), np.int32)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > hi[:-1]
    return np.stack([lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)]], axis=1).astype(np.int32)


def _blobs(batches: Iterator[pa.RecordBatch]) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            out.setdefault(kind, []).append(blob)
    return out


def _first_of_equal(shards: int, span: int, hot: int):
    """Of a shard's equal stretches all but the first are repeats; different ones with one anchor stay open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = _blobs(batches)
        if not blobs:
            return
        h, u, ids, tags, lo, n = unpack(RUN, blobs.get("run", []))
        order = _distinct([h, u, ids, tags, lo])
        h, u, ids, tags, lo, n = (c[order] for c in (h, u, ids, tags, lo, n))
        new_h = np.ones(len(h), dtype=bool)
        new_h[1:] = h[1:] != h[:-1]
        new = new_h.copy()
        new[1:] |= u[1:] != u[:-1]
        group = np.cumsum(new_h) - 1
        kinds = np.bincount(group[new]) if len(group) else np.empty(0, np.int64)
        opened = new & (kinds[group] > 1)
        far = lo.astype(np.int64) + n + (span - 1)
        known = unpack(FOUND, blobs.get("span", []))
        once = _distinct(known)
        known = [c[once] for c in known]
        found = [np.concatenate([k, c[~new]]) for k, c in zip(known, (ids, tags, lo, far.astype(np.int32)), strict=True)]
        yield from _to_documents(shards, found, [*(c[opened] for c in (ids, tags, h, lo, n)), (kinds[group[opened]] > hot).astype(np.uint8)])

    return run


def _texts_of_open(shards: int, span: int):
    """The texts of open stretches by anchor; for hot anchors the first of equal windows of a batch, and spans of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, windows, seen = [], [], [], set()
            columns = (batch.column(c) for c in ("key", "tag", "text", "reps"))
            for key, tag, text, reps in zip(*columns, strict=True):
                doc = (key.as_py(), tag.as_py())
                if doc in seen:
                    continue
                seen.add(doc)
                data = text.as_py().encode()
                for h, lo, n, hot in np.frombuffer(b"".join(reps.as_py()), dtype=OPEN).tolist():
                    if hot:
                        for at in range(lo, lo + n):
                            digest = hashlib.blake2b(data[at : at + span], digest_size=16).digest()
                            windows.append((int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:], "big"), *doc, at))
                    else:
                        rows.append((h, *doc, lo, n))
                        texts.append(data[lo : lo + n - 1 + span])
            parts = []
            if rows:
                columns = [np.array(c, dtype=t) for c, (_, t) in zip(zip(*rows, strict=True), REP, strict=True)]
                shard = shard_of(columns[0], shards)
                order = np.argsort(shard, kind="stable")
                edges = [*np.flatnonzero(np.diff(shard[order], prepend=-1)).tolist(), len(order)]
                for a, b in zip(edges, edges[1:], strict=False):
                    head = pack(REP, [c[order[a:b]] for c in columns])
                    body = b"".join(texts[i] for i in order[a:b].tolist())
                    parts.append((int(shard[order[a]]), "text", len(head).to_bytes(8, "little") + head + body))
            if windows:
                columns = [np.array(c, dtype=t) for c, (_, t) in zip(zip(*windows, strict=True), WINDOW, strict=True)]
                found, first = _first_windows(columns, span)
                parts += dealt("window", shard_of(columns[0][first], shards), WINDOW, [c[first] for c in columns])
                parts += dealt("span", doc_shard(found[0], found[1], shards), FOUND, found)
            if parts:
                yield _part_batch(parts)

    return run


def _first_windows(columns: list[np.ndarray], span: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Spans of all but the first of equal windows, and the places of the first ones."""
    a, b, ids, tags, lo = columns
    order = _distinct(columns)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    later = order[~new]
    return [ids[later], tags[later], lo[later], lo[later] + span], order[new]


class RunIndex:
    """Run-length compressed Burrows-Wheeler transform of some texts, for matches of ``span`` bytes.

    ``heads``, ``starts``, ``before``: symbol, first row of each run, and rows of the symbol
    in earlier runs; ``smaller``: rows of smaller symbols. ``ends``: text positions sampled at
    the first and last row of each run. ``marks`` and ``earliest``: first rows of the intervals
    of suffixes that share their first ``span`` bytes, and the least text position of each (−1
    for rows whose suffix is shorter).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, span: int):
        n_texts, sizes = len(offsets) - 1, np.diff(offsets)
        total = len(data) + n_texts
        symbols = np.zeros(total, dtype=np.int64)
        self.begins = offsets[:-1] + np.arange(n_texts)
        self.stops = self.begins + sizes
        inside = np.ones(total, dtype=bool)
        inside[self.stops] = False
        symbols[inside] = data.astype(np.int64) + 1
        owner = np.repeat(np.arange(n_texts), sizes + 1)
        left = self.stops[owner] - np.arange(total)
        # Ranks of the first 6 symbols, then of twice as many each time; an end mark is the least symbol.
        keys = np.zeros(total, dtype=np.int64)
        for j in range(6):
            keys <<= 9
            at = np.flatnonzero(left >= j)
            keys[at] |= symbols[at + j]
        ranks, reach = np.unique(keys, return_inverse=True)[1], 6
        shared = None
        while True:
            if shared is None and 2 * reach >= span:
                places = np.flatnonzero(left >= span)
                shared = np.full(total, -1, dtype=np.int64)
                shared[places] = ranks[places] * total + ranks[places + span - reach]
            if reach > sizes.max():
                break
            nxt = np.zeros(total, dtype=np.int64)
            at = np.flatnonzero(left >= reach)
            nxt[at] = ranks[at + reach] + 1
            ranks, reach = np.unique(ranks * (total + 1) + nxt, return_inverse=True)[1], 2 * reach
        rows = np.argsort(ranks, kind="stable")
        first = np.zeros(total, dtype=bool)
        first[self.begins] = True
        transform = np.where(first[rows], 0, symbols[rows - 1])
        change = np.flatnonzero(np.diff(transform, prepend=-1))
        self.starts, self.heads = change, transform[change]
        lengths = np.diff(np.append(change, total))
        self.ends = np.stack([rows[change], rows[change + lengths - 1]], axis=1)
        order = np.argsort(self.heads, kind="stable")
        upto = np.cumsum(lengths[order]) - lengths[order]
        # Rows begin with their symbols in order, so rows of one symbol lie together, run after run.
        self.before = np.empty(len(order), dtype=np.int64)
        self.before[order] = upto
        # The rows that begin with an end mark come first; they stand where the texts' first symbols are listed.
        interval = shared[rows]
        self.marks = np.flatnonzero(np.diff(interval, prepend=-2))
        least = np.minimum.reduceat(rows, self.marks)
        self.earliest = np.where(interval[self.marks] >= 0, least, -1)
        self.span = span

    def step(self, rows: np.ndarray) -> np.ndarray:
        """The row of each suffix extended to the left by one symbol."""
        run = np.searchsorted(self.starts, rows, side="right") - 1
        return self.before[run] + rows - self.starts[run]

    def seen_before(self) -> list[np.ndarray]:
        """For each text, the places at which a string of ``span`` bytes begins that also begins earlier."""
        n, sizes = len(self.begins), self.stops - self.begins
        order = np.argsort(-sizes, kind="stable")
        rows, at = order.copy(), self.stops[order]  # a text's end mark is the row of its number
        found_text, found_at = [], []
        for step in range(1, int(sizes.max(initial=0)) + 1):
            live = int(np.searchsorted(-sizes[order], -step, side="right"))
            rows, at, order = self.step(rows[:live]), at[:live] - 1, order[:live]
            if step >= self.span:
                earliest = self.earliest[np.searchsorted(self.marks, rows, side="right") - 1]
                hit = (earliest >= 0) & (earliest < at)
                found_text.append(order[hit])
                found_at.append(at[hit] - self.begins[order[hit]])
        if not found_text:
            return [np.empty(0, np.int64)] * n
        texts, places = np.concatenate(found_text), np.concatenate(found_at)
        by = np.lexsort((places, texts))
        return np.split(places[by], np.searchsorted(texts[by], np.arange(1, n)))


def _open_texts(blobs: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    rows, texts = [], []
    for blob in blobs:
        size = int.from_bytes(blob[:8], "little")
        rows.append(blob[8 : 8 + size])
        texts.append(blob[8 + size :])
    return unpack(REP, rows), texts


def _indexed(shards: int, span: int):
    """Repeats among the open texts of a shard, by indexes over whole anchors' texts, and among its single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = _blobs(batches)
        if not blobs:
            return
        spans = unpack(FOUND, blobs.get("span", []))
        once = _distinct(spans)
        found = [[c[once] for c in spans]]
        if "window" in blobs:
            found.append(_first_windows(unpack(WINDOW, blobs["window"]), span)[0])
        (h, ids, tags, lo, n), texts = _open_texts(blobs.get("text", []))
        sizes = n.astype(np.int64) + (span - 1)
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begins = np.cumsum(sizes) - sizes
        order = _distinct([h, ids, tags, lo])
        heads = np.append(np.flatnonzero(np.diff(h[order], prepend=h[order][:1] ^ np.uint64(1))), len(order)) if len(order) else np.zeros(1, np.int64)
        filled = np.append(0, np.cumsum(sizes[order]))
        a = 0
        while a < len(heads) - 1:
            b = max(a + 1, int(np.searchsorted(filled[heads], filled[heads[a]] + INDEX_BYTES, side="right")) - 1)
            rows = order[heads[a] : heads[b]]
            # Texts stand in corpus order, so that an earlier position in the index is an earlier one in the corpus.
            rows = rows[np.lexsort((lo[rows], tags[rows], ids[rows]))]
            offsets = np.append(0, np.cumsum(sizes[rows]))
            at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes[rows]) + np.repeat(begins[rows], sizes[rows])
            hits = RunIndex(data[at], offsets, span).seen_before()
            counts = np.array([len(x) for x in hits])
            owner = np.repeat(rows, counts)
            places = lo[owner] + (np.concatenate(hits) if len(hits) else np.empty(0, np.int64))
            found.append([ids[owner], tags[owner], places, places + span])
            a = b
        merged = [np.concatenate(c) for c in zip(*found, strict=True)]
        yield from _to_documents(shards, merged)

    return run


def _cut(keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, n_spans, digests, kept = [], [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = text.as_py().encode()
                all_spans = spans.as_py() or []
                both = np.frombuffer(b"".join(all_spans), dtype=SPANS)
                at, left, removed, cuts = 0, [], 0, pairs(both["lo"], both["hi"]).tolist()
                for a, b in cuts:
                    left.append(data[at:a])
                    removed, at = removed + b - a, b
                left = b"".join([*left, data[at:]])
                sizes.append(len(data))
                gone.append(removed)
                n_spans.append(len(cuts))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if keep_bytes else None)
            new = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *new], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, keep_bytes: bool = False, hot: int = HOT) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (the remaining bytes, if asked for) of every row.

    Texts are taken as UTF-8. A byte is removed if a string of ``span`` bytes that covers it
    also starts at a smaller id, or earlier in the same text; strings do not cross texts and
    are judged on the input. ``span`` is at least 64. ``hot`` only says from how many
    stretches of an anchor on its windows are dealt one by one; the result is the same.

    Null or empty text: no bytes. Null ids: before all others. Rows with one id and
    different texts: different documents, told apart and ordered by a hash of 64 bits; rows that repeat an id and its
    text: one document, so each gets the same result. Empty table: empty result. Other
    columns are ignored.
    """
    if span < 2 * GRAM:
        raise ValueError(f"span must be at least {2 * GRAM}")
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LOWEST)).alias("key"), F.xxhash64(text).alias("tag"), text.alias("text")
    )
    runs = own.mapInArrow(_anchors(shards, span), PART)

    def gathered(parts: DataFrame) -> DataFrame:
        return parts.repartition(shards, "shard").mapInArrow(_gathered, DOC)

    # One row per document, however many shards its stretches lie in.
    known = cut(gathered(runs.repartition(shards, "shard").mapInArrow(_first_of_equal(shards, span, hot), PART)))
    opened = known.filter(F.length("reps") > 0).select(F.col("key").alias("k"), F.col("tag").alias("t"), F.array("reps").alias("all"))
    same = (F.col("key") == F.col("k")) & (F.col("tag") == F.col("t"))
    wide = own.join(opened, same).select("key", "tag", "text", F.col("all").alias("reps"))
    late = gathered(wide.mapInArrow(_texts_of_open(shards, span), PART).repartition(shards, "shard").mapInArrow(_indexed(shards, span), PART))
    spans = known.unionByName(late).filter(F.length("spans") > 0).groupBy(F.col("key").alias("k"), F.col("tag").alias("t")).agg(F.collect_list("spans").alias("spans"))
    done = own.join(spans, same, "left").select("key", "text", "spans")
    schema = "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    cut_texts = done.mapInArrow(_cut(keep_bytes), schema)
    back = F.when(F.col("key") != _LOWEST, F.col("key")).alias(id_col)
    return cut_texts.select(back, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_bytes else []))
