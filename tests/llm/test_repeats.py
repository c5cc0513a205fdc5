import hashlib
import random

import numpy as np
import pytest

from lakemill.llm import repeats

from .cases import empty, odd

DOCS = "doc_id bigint, text string"


def brute(rows, span=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            if data[p : p + span] in seen:
                gone[p : p + span] = b"\1" * span
            seen.add(data[p : p + span])
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), sum(1 for q, g in enumerate(gone) if g and not (q and gone[q - 1])), hashlib.sha256(kept).hexdigest())
    return out


def sample(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([0, 50, 99, 100, 101, 150, 400, 1500]))) for _ in range(60)]
    rows = []
    for i in range(300):
        k = rng.random()
        if k < 0.3:
            text = rng.choice(base)
        elif k < 0.6:
            text = "".join(rng.choice(base)[a : a + rng.randint(60, 260)] for a in [rng.randint(0, 200) for _ in range(4)])
        elif k < 0.7:
            text = "ab" * rng.randint(0, 300)
        elif k < 0.75:
            text = "x" * rng.randint(0, 300)
        elif k < 0.8:
            text = None
        else:
            text = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 400)))
        rows.append((i * 7 - 500, text))
    return rows


@pytest.mark.parametrize("seed,hot,span", [(3, repeats.HOT, 100), (4, 1, 100), (5, 4, 64), (6, repeats.HOT, 150)])
def test_against_brute_force(spark, seed, hot, span):
    rows = sample(seed)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(df, hot=hot, span=span).collect()}
    assert got == brute(rows, span)


def test_kept_bytes(spark):
    text = "".join(random.Random(9).choices("abcdefghij", k=250))
    df = spark.createDataFrame([(2, "é" + text[20:180] + "ü"), (1, text)], DOCS)
    got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(df, keep_bytes=True).collect()}
    assert got == {1: text.encode(), 2: "éü".encode()}


def test_text_longer_than_a_piece(spark):
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, repeats.PIECE + 5_000, dtype=np.uint8).tobytes().decode()
    passage = text[repeats.PIECE - 300 : repeats.PIECE + 300]
    df = spark.createDataFrame([(1, text), (2, "-" * 20 + passage)], DOCS)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in repeats.remove_repeats(df).collect()}
    assert got == {1: (0, 0), 2: (600, 1)}


def test_odd_rows(spark):
    got = {r["doc_id"]: r for r in repeats.remove_repeats(odd(spark, ["key", "tag", "spans"])).collect()}
    assert got[1]["n_bytes"] == got[2]["n_bytes"] == 0
    assert got[7]["n_removed"] == 0
    assert got[8]["n_removed"] == got[7]["n_bytes"]
    assert None in got
    assert repeats.remove_repeats(odd(spark)).count() == 11
    assert repeats.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_run_index_against_search(seed):
    rng = random.Random(seed)
    pool = "".join(rng.choice("ab") for _ in range(400))
    texts = [pool[a : a + rng.randint(12, 60)].encode() for a in [rng.randint(0, 300) for _ in range(25)]]
    offsets = np.cumsum([0, *map(len, texts)])
    index = repeats.RunIndex(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, 12)
    seen, want = set(), []
    for t in texts:
        want.append([])
        for p in range(len(t) - 11):
            if t[p : p + 12] in seen:
                want[-1].append(p)
            seen.add(t[p : p + 12])
    assert [x.tolist() for x in index.seen_before()] == want
    assert len(index.starts) < len(b"".join(texts))


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_many_texts_without_id_are_documents_of_their_own(spark, hot):
    rng = random.Random(11)
    letters = lambda low, high: "".join(rng.choices("abcdefghij", k=rng.randint(low, high)))
    pairs = [(letters(0, 150), letters(0, 150), letters(110, 300), letters(0, 150), letters(0, 150)) for _ in range(2_000)]
    rows = [(None, f"{a}A{p}B{b}") for a, _, p, b, _ in pairs] + [(None, f"{c}C{p}D{d}") for _, c, p, _, d in pairs]
    got = [bytes(r["kept"]).decode() for r in repeats.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(5), keep_bytes=True, hot=hot).collect()]
    assert len(got) == len(rows)
    kept = set(got)
    for a, c, p, b, d in pairs:
        first, second = {f"{a}A{p}B{b}", f"{c}CD{d}"} <= kept, {f"{a}AB{b}", f"{c}C{p}D{d}"} <= kept
        assert first != second


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_rows_given_twice_are_one_document(spark, hot):
    rows = sample(8)
    want = brute(rows)
    given = rows + rows[::2] + rows[::2] + rows[::5]
    for df in (spark.createDataFrame(given, DOCS).repartition(5), spark.createDataFrame(sorted(given, key=lambda r: r[0]), DOCS).coalesce(1)):
        got = repeats.remove_repeats(df, hot=hot).collect()
        assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in given)
        assert all(tuple(r)[1:] == want[r["doc_id"]] for r in got)


def test_long_row_given_twice_keeps_its_bytes(spark):
    text = "".join(random.Random(12).choices("abcdefghij", k=500))
    df = spark.createDataFrame([(1, text), (1, text), (2, "-" + text[100:400]), (None, text + "+"), (None, text + "+")], DOCS).repartition(4)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    assert got == [(0, 501, 0), (0, 501, 0), (1, 500, 500), (1, 500, 500), (2, 301, 300)]


def test_rows_of_found_places_do_not_grow_with_the_shards(spark, monkeypatch):
    rng = random.Random(13)
    passages = ["".join(rng.choices("abcdefghij", k=150)) for _ in range(60)]
    rows = [(i, "-".join(rng.sample(passages, 20))) for i in range(80)]
    noted, real = [], repeats.cut
    monkeypatch.setattr(repeats, "cut", lambda df: noted.append(real(df)) or noted[-1])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == brute(rows)
    assert noted[0].count() <= len(rows)
