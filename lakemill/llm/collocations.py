"""Phrase collocations: FM-indexes over word ids, extended in both directions, counts summed across shards.

1. Words are counted per language. A phrase occurs no more often than any words, pairs or triples
   of neighbours in it, so the rest of the work needs only those that are frequent enough.
   Which ones are is found out one after the other and sent out as bitmaps of a fixed size: a bit
   may stand for more than one of them, which costs work and changes no result.
2. A shard is what a task reads, in pieces of bounded length: runs of frequent words whose
   neighbouring pairs are frequent, too. Over a shard's word ids two indexes are built, of the
   text and of the text read backwards, with suffixes in order up to the longest phrase.
3. Extension. All phrases of a length are intervals in both indexes. The symbols before an
   interval (in its Burrows-Wheeler transform) are the words that extend it on that side, with
   their counts; the interval in the other index shrinks to match. Phrases grow to the
   left and to the right in turn, all of a length at once, as far as their triples are frequent,
   and down to single occurrences.
4. Counts are summed across shards; only then is a phrase called rare. Scores, longer phrases
   that take a phrase in, and ranks are worked out from the sums. Words are known by ids until the
   end; how the words of the best phrases are spelt is looked up in the texts once more.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.textarrays import alphabet, key_groups, lists, mixed, stretches, word_edges, word_hashes
from lakemill.session import cut

LEAST = 100
LONGEST = 5
#: A phrase goes when a longer one around it has this share of its count, in hundredths.
SUBSUMED = 100
SCALE = 1000
TOP = 2000
NO_LANGUAGE = "und"
#: Bits of each filter, as a power of two.
FILTER_BITS = 25


class Limits(NamedTuple):
    """What a task holds: words of a shard, and counts before it passes them on. Results do not depend on either."""

    shard: int = 1 << 21
    held: int = 1 << 22


_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
#: Words end at blanks and where pieces end.
PIECE_WORDS = alphabet([(0x09, 0x0D), (0x20, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F)])
_PAIR = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


class Read(NamedTuple):
    """Words of a stretch in order: ids that differ between languages, whether the next word is in the same piece, their bytes."""

    ids: np.ndarray
    goes_on: np.ndarray
    langs: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray


def read_words(data: np.ndarray, offsets: np.ndarray, lang_of_row: np.ndarray, salts: np.ndarray) -> Read:
    starts, stops = word_edges(data, offsets, PIECE_WORDS)
    firsts = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    langs = lang_of_row[rows]
    ids = mixed(word_hashes(data, starts, stops, PIECE_WORDS) ^ salts[langs])
    breaks = np.concatenate([[0], np.cumsum(_BREAKS[data])])
    goes_on = np.zeros(len(ids), bool)
    goes_on[:-1] = (rows[1:] == rows[:-1]) & (breaks[starts[1:]] == breaks[stops[:-1]])
    return Read(ids, goes_on, langs, data, starts, stops)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Read, list[str]]]:
    for batch in batches:
        coded = pc.fill_null(batch.column("lang"), NO_LANGUAGE).dictionary_encode()
        names = coded.dictionary.to_pylist()
        salts = np.array([xxhash.xxh64_intdigest(n) for n in names], dtype=np.uint64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        for first, last, data, offsets in stretches(batch.column("text")):
            yield read_words(data, offsets, codes[first:last], salts), names


def in_filter(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    place = ids >> np.uint64(64 - 5 - len(bits).bit_length())
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def make_filter(ids: DataFrame, column: str, size: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of 2 to the power ``size`` bits, with those set that the ids of the column begin with. Only that reaches the driver."""
    place = F.shiftrightunsigned(column, 64 - size)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    packed = ids.groupBy(F.shiftright(place, 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), dtype=np.uint64)
    out[packed.column("slot").to_numpy()] = packed.column("bits").to_numpy().view(np.uint64)
    return out


def _count_words(limits: Limits):
    """Rows (lang, null, n) for all words of a language and (lang, id, n) for a word; a task adds up what it can hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, totals = [], 0, {}

        def passed_on() -> pa.RecordBatch:
            every = np.concatenate([h[0] for h in held])
            ids, once, place = np.unique(every, return_index=True, return_inverse=True)
            n = np.zeros(len(ids), np.int64)
            np.add.at(n, place, np.concatenate([h[1] for h in held]))
            langs = pa.chunked_array([h[2] for h in held]).take(pa.array(once)).combine_chunks()
            return pa.RecordBatch.from_arrays([langs, pa.array(ids.view(np.int64)), pa.array(n)], ["lang", "wid", "n"])

        for read, names in _read_batches(batches):
            for code, n in zip(*np.unique(read.langs, return_counts=True), strict=True):
                totals[names[code]] = totals.get(names[code], 0) + int(n)
            ids, once, n = np.unique(read.ids, return_index=True, return_counts=True)
            held.append((ids, n, pa.array(names, pa.string()).take(pa.array(read.langs[once].astype(np.int64)))))
            n_held += len(ids)
            if n_held > limits.held:
                yield passed_on()
                held, n_held = [], 0
        if n_held:
            yield passed_on()
        if totals:
            rows = [pa.array(list(totals), pa.string()), pa.nulls(len(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, ["lang", "wid", "n"])

    return run


def pair_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * _PAIR[0] + right * _PAIR[1], 29)


def triple_ids(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mixed(pair_ids(first, second) * _PAIR[0] + pair_ids(second, third) * _PAIR[1], 31)


def frequent_pairs(read: Read, words_ok: np.ndarray, pairs_ok: np.ndarray | None = None) -> np.ndarray:
    """Places of words that, like the next one of their piece, pass the filter, and as pairs the other one, if it is given."""
    ok = in_filter(words_ok, read.ids)
    at = np.flatnonzero(read.goes_on[:-1] & ok[:-1] & ok[1:]) if len(ok) > 1 else np.empty(0, np.int64)
    return at if pairs_ok is None else at[in_filter(pairs_ok, pair_ids(read.ids[at], read.ids[at + 1]) << _LOW)]


#: The shard of a pair or triple follows from the high half of its id. Within a shard the low half stands for it: that two
#: share one costs work and changes no result, and is as rare with many shards as with few.
_LOW = np.uint64(32)


def _shards(ids: np.ndarray, shards: int) -> np.ndarray:
    return ((ids >> _LOW) * np.uint64(shards) >> _LOW).astype(np.int64)


def _count_grams(words_ok, pairs_ok, least: int, shards: int, limits: Limits):
    """Counts of pairs of neighbours, or of triples whose pairs pass the filter, up to ``least``, packed by shard."""
    kind = np.min_scalar_type(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def passed_on() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(_shards(grams, shards), np.arange(shards + 1))
            low, counts = grams.astype(np.uint32), np.minimum(n, least).astype(kind)
            full = [s for s in range(shards) if ends[s] < ends[s + 1]]
            blobs = [low[ends[s] : ends[s + 1]].tobytes() + counts[ends[s] : ends[s + 1]].tobytes() for s in full]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])

        for read, _ in _read_batches(batches):
            if pairs_ok is None:
                at = frequent_pairs(read, words_ok.value)
                grams = pair_ids(read.ids[at], read.ids[at + 1])
            else:
                at = frequent_pairs(read, words_ok.value, pairs_ok.value)
                at = at[:-1][at[1:] == at[:-1] + 1] if len(at) > 1 else at[:0]
                grams = triple_ids(read.ids[at], read.ids[at + 1], read.ids[at + 2])
            held.append(grams)
            n_held += len(grams)
            if n_held > limits.held:
                yield passed_on()
                held, n_held = [], 0
        if n_held:
            yield passed_on()

    return run


def _merge_grams(least: int):
    """Low halves, as leading bits, of the pairs or triples that reach ``least``. Rows come by shard, and a shard's are in one partition."""
    kind = np.dtype(np.min_scalar_type(least))

    def frequent(blobs: list[bytes]) -> pa.RecordBatch:
        sizes = [len(b) // (4 + kind.itemsize) for b in blobs]
        grams = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, sizes, strict=True)])
        counts = np.concatenate([np.frombuffer(b, kind, n, 4 * n) for b, n in zip(blobs, sizes, strict=True)]).astype(np.int64)
        distinct, sums = _summed(grams, counts)
        return pa.RecordBatch.from_arrays([pa.array((distinct[sums >= least].astype(np.uint64) << _LOW).view(np.int64))], ["gram"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_groups(batches, "shard"):
            yield frequent(rows.column("blob").to_pylist())

    return run


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, place, counts)
    return distinct, sums


class FmIndex:
    """Suffixes of a text of symbols, in order up to ``depth`` symbols, as a transform and the step to the symbol before.

    Symbol 0 ends runs; the last symbol is 0. That suffixes are in order only so far is enough
    for patterns of up to ``depth`` symbols: where a pattern's interval begins is a matter of its
    symbols, and so is, counted in the transform, where each extended pattern's does.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, have = text.astype(np.int64), 1
        order = np.argsort(rank)
        while have < depth:
            # Ranks of ``have`` symbols from here and from ``step`` later on: those of both together.
            step = min(have, depth - have)
            later = np.zeros(n, np.int64)
            later[: n - step] = rank[step:]
            key = rank * (n + 1) + later
            order = np.argsort(key)
            new = np.zeros(n, np.int64)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            have += step
        self.transform = text[order - 1]
        self.firsts = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.step = np.empty(n, np.int64)
        self.step[np.argsort(self.transform, kind="stable")] = np.arange(n)

    def extend(self, low: np.ndarray, size: np.ndarray):
        """All patterns that are one symbol longer: pattern extended, symbol, begin and size of the interval, and how many of the
        extended pattern's occurrences have a smaller symbol there."""
        owner = np.repeat(np.arange(len(low)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        symbol = self.transform[place]
        order = np.argsort(owner * len(self.firsts) + symbol, kind="stable")
        owner, symbol, place = owner[order], symbol[order], place[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
        heads = np.flatnonzero(new)
        counts = np.diff([*heads, len(owner)])
        smaller = heads - np.concatenate([[0], np.cumsum(size)])[owner[heads]]
        real = symbol[heads] > 0
        heads = heads[real]
        return owner[heads], symbol[heads], self.step[place[heads]], counts[real], smaller[real]


def phrases(text: np.ndarray, longest: int, may=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length from 2 on: all phrases of a text of symbols (a row each) and how often they occur.

    ``may`` tells which triples of symbols to go on with: phrases around others are left out.
    """
    ahead, back = FmIndex(text, longest), FmIndex(np.concatenate([text[-2::-1], text[-1:]]), longest)
    symbols = np.arange(1, len(ahead.firsts) - 1)
    low, size = ahead.firsts[symbols], np.diff(ahead.firsts)[symbols]
    low_back, found = back.firsts[symbols], symbols[:, None]
    for length in range(2, longest + 1):
        if length % 2 == 0:
            owner, symbol, low, size, smaller = ahead.extend(low, size)
            low_back = low_back[owner] + smaller
            found = np.concatenate([symbol[:, None], found[owner]], axis=1)
        else:
            owner, symbol, low_back, size, smaller = back.extend(low_back, size)
            low = low[owner] + smaller
            found = np.concatenate([found[owner], symbol[:, None]], axis=1)
        if may is not None and length > 2:
            # One triple is new, at the end that has grown.
            ok = may(found[:, :3] if length % 2 == 0 else found[:, -3:])
            low, low_back, size, found = low[ok], low_back[ok], size[ok], found[ok]
        yield found, size


COUNTED = "shard int, size int, blob binary"


def _count_phrases(words_ok, pairs_ok, triples_ok, longest: int, shards: int, limits: Limits):
    """Counts of the phrases of each shard of text, packed by the shard that sums them up and by length."""

    def counted(runs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        # Runs end with 0, which is the least id: its symbol is 0, too.
        ids, text = np.unique(np.concatenate(runs), return_inverse=True)
        may = lambda t: in_filter(triples_ok.value, triple_ids(ids[t[:, 0]], ids[t[:, 1]], ids[t[:, 2]]) << _LOW)
        for found, n in phrases(text, longest, may):
            spread = np.zeros(len(n), np.uint64)
            for column in found.T:
                spread = mixed(spread * _PAIR[0] + ids[column], 37)
            shard = _shards(spread, shards)
            order = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(shards + 1))
            rows, n = ids[found[order]], n[order].astype(np.int64)
            full = [s for s in range(shards) if ends[s] < ends[s + 1]]
            blobs = [rows[ends[s] : ends[s + 1]].tobytes() + n[ends[s] : ends[s + 1]].tobytes() for s in full]
            sizes = pa.array([found.shape[1]] * len(full), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), sizes, pa.array(blobs, pa.binary())], ["shard", "size", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, n_held = [], 0
        for read, _ in _read_batches(batches):
            first = np.zeros(len(read.ids), bool)
            first[frequent_pairs(read, words_ok.value, pairs_ok.value)] = True
            used = first.copy()
            used[1:] |= first[:-1]
            ends = np.flatnonzero(used & ~first)
            kept = np.flatnonzero(used)
            runs.append(np.insert(read.ids[kept], np.searchsorted(kept, ends) + 1, 0))
            n_held += len(runs[-1])
            if n_held >= limits.shard:
                yield from counted(runs)
                runs, n_held = [], 0
        if n_held:
            yield from counted(runs)

    return run


def _sum_phrases(least: int):
    """Phrases whose counts reach ``least`` in all. Rows come by shard, and a shard's are in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_groups(batches, "shard"):
            by_size: dict[int, list[bytes]] = {}
            for k, blob in zip(rows.column("size").to_pylist(), rows.column("blob").to_pylist(), strict=True):
                by_size.setdefault(k, []).append(blob)
            for k, blobs in by_size.items():
                sizes = [len(b) // (8 * k + 8) for b in blobs]
                keys = np.concatenate([np.frombuffer(b, np.dtype((np.void, 8 * k)), n) for b, n in zip(blobs, sizes, strict=True)])
                counts = np.concatenate([np.frombuffer(b, np.int64, n, 8 * k * n) for b, n in zip(blobs, sizes, strict=True)])
                distinct, sums = _summed(keys, counts)
                often = distinct[sums >= least]
                words_of = np.frombuffer(often.tobytes(), np.int64)
                yield pa.RecordBatch.from_arrays([lists(np.full(len(often), k), pa.array(words_of)), pa.array(sums[sums >= least])], ["phrase", "f"])

    return run


def _spell(wanted):
    """Each word that passes the filter, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, np.empty(0, np.uint64)
        for read, _ in _read_batches(batches):
            ids, once = np.unique(read.ids, return_index=True)
            new = in_filter(bits, ids)
            new[new] = ~np.isin(ids[new], seen, assume_unique=True)
            if new.any():
                seen, at, text = np.union1d(seen, ids[new]), once[new], read.data.tobytes()
                spelt = [text[a:b].lower().decode() for a, b in zip(read.starts[at].tolist(), read.stops[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[new].view(np.int64)), pa.array(spelt, pa.string())], ["wid", "word"])

    return run


def count_phrases(
    own: DataFrame, least: int, longest: int, filter_bits: int = FILTER_BITS, limits: Limits = Limits()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n), words (lang, wid, f) and phrases (ids of their words, f) of (text, lang), with ``f`` >= ``least``."""
    spark = own.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = own.mapInArrow(_count_words(limits), "lang string, wid bigint, n bigint").groupBy("lang", "wid").agg(F.sum("n").alias("n"))
    kept = cut(counted.filter((F.col("n") >= least) | F.col("wid").isNull()))
    totals, known = kept.filter("wid is null").select("lang", "n"), kept.filter("wid is not null").select("lang", "wid", F.col("n").alias("f"))
    send = spark.sparkContext.broadcast
    by_shard = lambda df: df.repartition(shards, "shard").sortWithinPartitions("shard")

    def grams_ok(pairs_ok):
        packed = own.mapInArrow(_count_grams(words_ok, pairs_ok, least, shards, limits), "shard int, blob binary")
        return send(make_filter(by_shard(packed).mapInArrow(_merge_grams(least), "gram bigint"), "gram", filter_bits))

    words_ok = send(make_filter(known, "wid", filter_bits))
    pairs_ok = grams_ok(None)
    triples_ok = grams_ok(pairs_ok)
    counts = own.mapInArrow(_count_phrases(words_ok, pairs_ok, triples_ok, longest, shards, limits), COUNTED)
    return totals, known, cut(by_shard(counts).mapInArrow(_sum_phrases(least), "phrase array<bigint>, f bigint"))


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def score_phrases(totals: DataFrame, known: DataFrame, found: DataFrame, scale: int = SCALE, subsumed: int = SUBSUMED) -> DataFrame:
    """lang, phrase (ids), a, l, r, n, score, n_left, n_right of every phrase that no longer one takes in.

    ``n_left`` and ``n_right``: frequent phrases that are longer by a word on that side.
    """
    size = F.size("phrase")
    parts = known.select(F.array("wid").alias("part"), "f").unionByName(found.select(F.col("phrase").alias("part"), "f"))
    first = known.select(F.col("wid").alias("head"), "lang").join(totals, "lang")
    cuts = found.withColumnRenamed("f", "a").select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("phrase", F.lit(1), F.col("k")), "right": F.slice("phrase", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(parts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left").join(parts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.join(first, F.get("phrase", F.lit(0)) == F.col("head"))
    # Products may pass 64 bits; the quotient of whole decimals is exact and rounds down.
    above, below = F.lit(scale).cast("decimal(10,0)") * (_exact("a") * _exact("n")), _exact("l") * _exact("r")
    cuts = cuts.withColumns({"above": above, "below": below}).withColumn("score", F.expr("above div below"))
    scored = cuts.groupBy("phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n", "lang")).alias("least"))
    inner = lambda start, side: F.struct(F.slice("phrase", F.lit(start), size - 1).alias("inner"), F.lit(side).alias("side"))
    longer = found.filter(size > 2).select(F.explode(F.array(inner(2, "left"), inner(1, "right"))).alias("x"), "f").select("x.inner", "x.side", "f")
    around = longer.groupBy("inner").agg(
        F.max("f").alias("most"), F.count_if(F.col("side") == "left").alias("n_left"), F.count_if(F.col("side") == "right").alias("n_right")
    )
    met = scored.join(around, F.col("phrase") == F.col("inner"), "left")
    kept = met.filter(F.coalesce(100 * F.col("most") < subsumed * F.col("least.a"), F.lit(True)))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return kept.select("least.lang", "phrase", "least.a", "least.l", "least.r", "least.n", "least.score", zero("n_left"), zero("n_right"))


def spell_phrases(own: DataFrame, scored: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``scored`` with phrases as text. Words are looked up in the texts; of the ids only a bitmap is sent out."""
    wids = scored.select(F.explode("phrase").alias("wid"))
    wanted = own.sparkSession.sparkContext.broadcast(make_filter(wids, "wid", filter_bits))
    spelt = own.mapInArrow(_spell(wanted), "wid bigint, word string").groupBy("wid").agg(F.min("word").alias("word"))
    each = scored.select("phrase", F.posexplode("phrase").alias("at", "wid")).join(spelt, "wid")
    listed = F.array_sort(F.collect_list(F.struct("at", "word")))
    named = each.groupBy("phrase").agg(F.array_join(F.transform(listed, lambda x: x["word"]), " ").alias("spelt"))
    return scored.join(named, "phrase").drop("phrase").withColumnRenamed("spelt", "phrase")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    scale: int = SCALE,
    subsumed: int = SUBSUMED,
    filter_bits: int = FILTER_BITS,
    limits: Limits = Limits(),
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score, n_left, n_right.

    A-Z are taken as a-z; texts are split into pieces at ``.,;:!?`` and line ends, pieces into words at
    blanks and tabs. A phrase is 2 to ``longest`` words in a row within a piece, and counts
    (``a``) at least ``least`` times in its language, overlaps included. Cut after k words, its parts
    count l and r, and its score is floor(scale·a·n/(l·r)) with n words in the language; the lowest
    cut counts, ties to the least k. It is dropped if a longer phrase around it has
    ``subsumed`` hundredths of its count. Rank: by score and a, descending, then by UTF-8 bytes.

    Counts are exact but for words taken for one another by 64 bits of their hashes. Null text:
    no words. Null language: ``und``. Repeated rows count each; ids and other columns are not
    looked at. A very long text is one shard. Empty table: empty result.
    """
    own = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    scored = score_phrases(*count_phrases(own, least, longest, filter_bits, limits), scale, subsumed)
    # Ties at the end of the list stay until their phrases are spelt. Spark cuts languages to the best below the shuffle.
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = cut(scored.withColumn("place", F.rank().over(by_score)).filter(F.col("place") <= top).drop("place"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spell_phrases(own, best, filter_bits).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", "n_left", "n_right")
