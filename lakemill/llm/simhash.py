"""SimHash near copies: bit counts of segments, a grid over them, exact distances.

1. A fingerprint has a bit where more than half of a text's shingle hashes have it. Equal
   fingerprints are one from here on.
2. Embedding. A fingerprint is cut into segments, and the number of set bits in each is a
   coordinate. A bit that differs moves one coordinate by one, so the Manhattan distance of two
   embeddings never exceeds the Hamming distance of the fingerprints.
3. Grid range join. The segments are dealt to ``distance // 2 + 1`` groups. Of two fingerprints
   within the distance, at least one group is at a Manhattan distance of 0 or 1: its
   coordinates are equal, or one of them is one higher. A fingerprint has its own cell in each
   group, and looks into the cells one step up each axis. That finds every pair, from one
   side only.
4. What meets in a cell is compared bit by bit. A cell that holds very many is cut into blocks,
   a tile for each pair of them, so that no task holds more than a few blocks.
5. Components of the links found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.components import components, contract
from lakemill.llm.textarrays import NON_BLANK, mixed, stretches, word_edges
from lakemill.operators.bounds import checked_broadcast
from lakemill.session import cut

SHINGLE = 3
DISTANCE = 2
SEED = 42
BITS = 64
SEGMENT = 2
#: Fingerprints in a block: a tile compares one block with another.
BLOCK = 4096
#: Shingles whose hashes are held at a time.
_CHUNK = 1 << 17
_PAIRS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The eight bits of a byte as eight counters of a byte each, the lowest bit first.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1).view("<u8")


def spaced(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one blank after each, and where each begins and ends there."""
    inside = NON_BLANK.is_word[data]
    used = inside.copy()
    used[stops[stops < len(data)]] = True
    place = np.cumsum(used) - 1
    text = np.where(inside, _LOWER[data], np.uint8(32))[used]
    first = place[starts]
    return text, first, first + (stops - starts)


def shingle_spans(first: np.ndarray, end: np.ndarray, rows: np.ndarray, counts: np.ndarray, firsts: np.ndarray, k: int):
    """Begin, end and row of each shingle in order: runs of k words of a row, or all words of a shorter one."""
    n = max(0, len(first) - k + 1)
    whole = np.flatnonzero(rows[:n] == rows[k - 1 : k - 1 + n])
    short = np.flatnonzero((counts > 0) & (counts < k))
    begin = np.concatenate([first[whole], first[firsts[short]]])
    stop = np.concatenate([end[whole + k - 1], end[firsts[short] + counts[short] - 1]])
    row = np.concatenate([rows[whole], short])
    order = np.argsort(row, kind="stable")
    return begin[order], stop[order], row[order]


def bit_counts(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """How many hashes of each row have each bit; ``rows`` ascend."""
    counts = np.zeros((n_rows, BITS), dtype=np.int64)
    if not len(hashes):
        return counts
    # Counters of a byte hold 255: a run of a row is added up in pieces of at most that many.
    new = np.ones(len(rows), dtype=bool)
    new[1:] = rows[1:] != rows[:-1]
    heads = np.flatnonzero(new)
    within = np.arange(len(rows)) - np.repeat(heads, np.diff([*heads, len(rows)]))
    cuts = np.flatnonzero(within % 255 == 0)
    as_bytes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for j in range(8):
        sums = np.add.reduceat(_SPREAD[as_bytes[:, j]], cuts).view(np.uint8).reshape(-1, 8)
        np.add.at(counts[:, 8 * j : 8 * j + 8], rows[cuts], sums)
    return counts


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text of an Arrow column, as unsigned numbers; 0 where there are no words."""
    out = np.zeros(len(column), dtype=np.uint64)
    for first_row, last_row, data, offsets in stretches(column):
        starts, stops = word_edges(data, offsets, NON_BLANK)
        if not len(starts):
            continue
        firsts = np.searchsorted(starts, offsets)
        counts = np.diff(firsts)
        rows = np.repeat(np.arange(len(counts)), counts)
        text, first, end = spaced(data, starts, stops)
        begin, stop, row = shingle_spans(first, end, rows, counts, firsts, shingle)
        view, totals = memoryview(np.ascontiguousarray(text)), np.zeros((last_row - first_row, BITS), dtype=np.int64)
        for at in range(0, len(begin), _CHUNK):
            part = slice(at, at + _CHUNK)
            spans = zip(begin[part].tolist(), stop[part].tolist(), strict=True)
            hashes = np.fromiter((xxhash.xxh64_intdigest(view[a:b], SEED) for a, b in spans), np.uint64)
            totals[row[part][0] : row[part][-1] + 1] += bit_counts(hashes, row[part] - row[part][0], row[part][-1] + 1 - row[part][0])
        bits = 2 * totals > np.bincount(row, minlength=len(counts))[:, None]
        out[first_row:last_row] = np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def _fingerprinted(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fingerprints(batch.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made)], ["id", "print"])

    return run


def segment_counts(prints: np.ndarray) -> np.ndarray:
    """The embedding: set bits of each segment, a row for each fingerprint."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(prints), BITS // SEGMENT, SEGMENT).sum(axis=2, dtype=np.uint8)


def _groups(distance: int) -> list[np.ndarray]:
    """Segments of each group. Neighbours are dealt apart, so that groups are alike."""
    n = distance // 2 + 1
    return [np.arange(g, BITS // SEGMENT, n) for g in range(n)]


def cells(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell, index of the fingerprint, and whether it only looks in, for every row the grid join takes."""
    counts = segment_counts(prints)
    cell, owner, looks = [], [], []
    for g, segments in enumerate(_groups(distance)):
        # A cell's number: coordinates as digits, which take less than 64 bits, spread.
        digits = np.uint64(SEGMENT + 1) ** np.arange(len(segments), dtype=np.uint64)
        own = (counts[:, segments].astype(np.uint64) * digits).sum(axis=1, dtype=np.uint64)
        cell.append(mixed(own, 101 + g))
        owner.append(np.arange(len(prints)))
        looks.append(np.zeros(len(prints), bool))
        if distance:
            at, axis = np.nonzero(counts[:, segments] < SEGMENT)
            cell.append(mixed(own[at] + digits[axis], 101 + g))
            owner.append(at)
            looks.append(np.ones(len(at), bool))
    return np.concatenate(cell), np.concatenate(owner), np.concatenate(looks)


def _gridded(distance: int, homes: bool, steps: bool):
    """Rows of the grid for each fingerprint: its homes, and the cells it looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            cell, owner, looks = cells(prints, distance)
            kept = (homes & ~looks) | (steps & looks)
            arrays = [pa.array(cell[kept].view(np.int64)), pa.array(prints[owner[kept]].view(np.int64)), pa.array(looks[kept])]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "print", "looks"])

    return run


GRID = "cell bigint, print bigint, looks boolean"


def close_pairs(homes: np.ndarray, others: np.ndarray, distance: int) -> np.ndarray:
    """Pairs of ``homes`` and ``others`` that differ in at most ``distance`` bits; a bounded number is compared at a time."""
    found, step = [], max(1, _PAIRS // max(1, len(others)))
    for at in range(0, len(homes), step):
        near = np.bitwise_count(homes[at : at + step, None] ^ others[None, :]) <= distance
        a, b = np.nonzero(near)
        found.append(np.stack([homes[at + a], others[b]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.uint64)


#: Tiles of up to so many rows are compared side by side, larger ones one by one.
_SMALL = 32
#: What a row is in its tile: held and compared with its like, held, or compared with what is held.
AMONG, HELD, PASSING = 0, 1, 2


def tile_links(tiles: np.ndarray, sides: np.ndarray, prints: np.ndarray, distance: int) -> np.ndarray:
    """Links within each of some whole tiles, whose rows stand together."""
    new = np.ones(len(tiles), dtype=bool)
    new[1:] = tiles[1:] != tiles[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff([*heads, len(tiles)])
    found = []
    # Small tiles: every row with the row d places on, as long as the tile reaches that far.
    left = np.repeat(np.where(sizes <= _SMALL, sizes, 0), sizes) - (np.arange(len(tiles)) - np.repeat(heads, sizes))
    at, d = np.flatnonzero(left > 1), 1
    while len(at):
        near = at[np.bitwise_count(prints[at] ^ prints[at + d]) <= distance]
        found.append(np.stack([prints[near], prints[near + d]], axis=1))
        d += 1
        at = at[left[at] > d]
    for i in np.flatnonzero(sizes > _SMALL):
        own, side = prints[heads[i] : heads[i] + sizes[i]], sides[heads[i] : heads[i] + sizes[i]]
        found.append(close_pairs(own[side == AMONG], own[side == AMONG], distance))
        found.append(close_pairs(own[side != PASSING], own[side == PASSING], distance))
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.uint64)
    return pairs[pairs[:, 0] != pairs[:, 1]]


def _compare(distance: int):
    """Links within each tile, as stars. Rows come by tile; the last tile of a batch waits for the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def stars(upto: int | None) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held[:] = [[c[upto:] for c in columns]] if upto is not None else []
            links = contract(tile_links(*[c[:upto] for c in columns], distance).view(np.int64))
            if len(links):
                yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tiles = batch.column("tile").to_numpy()
            last = int(np.flatnonzero(np.concatenate([[True], tiles[1:] != tiles[:-1]]))[-1])
            before = sum(len(h[0]) for h in held)
            goes_on = held and held[-1][0][-1] == tiles[0] and last == 0
            held.append([tiles, batch.column("side").to_numpy(), batch.column("print").to_numpy().view(np.uint64)])
            if not goes_on and before + last:
                yield from stars(before + last)
        if held:
            yield from stars(None)

    return run


def _tiled(grid: DataFrame, homes: DataFrame, distance: int, block: int) -> DataFrame:
    """tile, side and fingerprint of every comparison: one tile a cell, pairs of blocks for a crowded one.

    How crowded a cell is follows from the homes alone: those in it, and those one step below,
    which look in. Cells with few of either need no entry.
    """
    homes_in = homes.groupBy("cell").agg(F.count(F.lit(1)).alias("homes")).filter(F.col("homes") > block)
    # A crowd beside a cell may look into it, so its rows are counted where they go.
    crowds = homes.join(homes_in.select(F.col("cell").alias("c")), F.col("cell") == F.col("c"), "left_semi")
    steps = crowds.select("print").distinct().mapInArrow(_gridded(distance, False, True), GRID)
    looks_in = steps.groupBy("cell").agg(F.count(F.lit(1)).alias("looks_in")).filter(F.col("looks_in") > block)
    crowded = homes_in.join(looks_in, "cell", "full").select(
        F.col("cell").alias("c"),
        F.ceil(F.coalesce("homes", F.lit(1)) / block).cast("int").alias("home_blocks"),
        F.ceil(F.coalesce("looks_in", F.lit(1)) / block).cast("int").alias("look_blocks"),
    )
    met = grid.join(checked_broadcast(cut(crowded)), F.col("cell") == F.col("c"), "left")
    h, k = F.coalesce("home_blocks", F.lit(1)), F.coalesce("look_blocks", F.lit(1))
    own = F.pmod(F.xxhash64("print"), F.when(F.col("looks"), k).otherwise(h)).cast("int")
    at = lambda kind, i, j, side: F.struct(F.xxhash64("cell", F.lit(kind), i, j).alias("tile"), F.lit(side).alias("side"))
    # Tiles: a home block with itself and the first block that looks in; two home blocks; a home block and a further one that looks in.
    with_home = lambda b: F.when(b == own, at(0, b, b, AMONG)).when(b > own, at(1, own, b, HELD)).otherwise(at(1, b, own, PASSING))
    each_home = F.sequence(F.lit(0), h - 1)
    further = F.when(k > 1, F.transform(F.sequence(F.lit(1), k - 1), lambda j: at(2, own, j, HELD))).otherwise(F.array())
    into = F.transform(each_home, lambda b: F.when(own == 0, at(0, b, b, PASSING)).otherwise(at(2, b, own, PASSING)))
    places = F.when(F.col("looks"), into).otherwise(F.concat(F.transform(each_home, with_home), further))
    return met.select(F.explode(places).alias("at"), "print").select("at.tile", "at.side", "print")


def close_links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct values of ``print`` within ``distance`` bits of each other."""
    shards = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = prints.mapInArrow(_gridded(distance, True, True), GRID)
    homes = prints.mapInArrow(_gridded(distance, True, False), GRID).select("cell", "print")
    tiles = _tiled(grid, homes, distance, block)
    met = tiles.repartition(shards, "tile").sortWithinPartitions("tile")
    return met.mapInArrow(_compare(distance), "a bigint, b bigint")


def link_by_simhash(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """id, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    Words are runs without blanks, A-Z taken as a-z; a shingle is ``shingle`` words joined by
    blanks, repeats included (all words of a shorter text), hashed by XXH64 of its UTF-8 bytes
    with seed 42. Texts link when their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the least id reachable. Every such pair is found or stands in a component
    that links found already connect; links are not listed beyond that.

    Null or wordless text: fingerprint zero, linked like any other. Null ids: such rows link
    others like any row, and their component's id is the least id that is not null (null if
    there is none). Rows that repeat an id or a text: each keeps its own result. Empty table:
    empty result. Other columns are ignored.
    """
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    known = cut(own.mapInArrow(_fingerprinted(shingle), "id bigint, print bigint"))
    classes = cut(known.groupBy("print").agg(F.min("id").alias("least")))
    groups = components(close_links(classes.select("print"), distance, block))
    rooted = classes.join(groups, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(F.col("print").alias("p"), "component_id")
    return known.join(named, F.col("print") == F.col("p")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
