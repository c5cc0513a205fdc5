import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemill.llm import alignment

from .cases import empty, odd

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers as their own libraries give them: ids of a text, and the bytes of an id."""
    hf = Tokenizer.from_file(alignment.A_PATH)
    hf.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=alignment.B_PATH)
    byte_of = alignment.byte_level_chars()
    a_bytes = lambda i: bytes(byte_of[c] for c in hf.id_to_token(i))
    b_bytes = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    return lambda t: hf.encode(" " + t, add_special_tokens=False).ids, a_bytes, lambda t: sp.encode(t), b_bytes


def brute(rows, plain):
    a_ids, a_bytes, b_ids, b_bytes = plain
    out, links = {}, {}
    for key, text in rows:
        x, y = (a_ids(text), b_ids(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(map(a_bytes, x)) != whole or b"".join(map(b_bytes, y)) != whole:
            x, y = [], []
        ends_a = np.cumsum([len(a_bytes(i)) for i in x]).tolist()
        ends_b = np.cumsum([len(b_bytes(i)) for i in y]).tolist()
        links[key] = [(p, q) for p, e in zip(x, ends_a, strict=True) for q, f in zip(y, ends_b, strict=True) if e == f]
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = []
        for low, high in zip([0, *cuts], cuts, strict=False):
            sides = [",".join(str(i) for i, e in zip(ids, ends, strict=True) if low < e <= high) for ids, ends in ((x, ends_a), (y, ends_b))]
            groups.append("|".join(sides))
        out[key] = [len(x), len(y), len(groups), len(links[key]), ";".join(groups)]
    totals = Counter(pair for found in links.values() for pair in found)
    highest = Counter()
    for (_, q), n in totals.items():
        highest[q] = max(highest[q], n)
    for key, found in links.items():
        out[key] += [sum(totals[p] == highest[p[1]] for p in found), sum(totals[p] for p in found)]
    return {k: tuple(v) for k, v in out.items()}


def sample():
    rng = random.Random(4)
    stuff = ["the", "tokenizers", "don't", "  ", "\n\n", "Ünïcödé", "日本語", "1234567", "\t", "<s>", "<|endoftext|>", "é", "\U0001f600", "...", "antidisestablishment", "<0x41>"]
    rows = [(i, rng.choice([" ", "", "\n"]).join(rng.choice(stuff) for _ in range(rng.randint(1, 60)))) for i in range(80)]
    return rows + [(100, None), (101, ""), (102, " "), (103, "▁x"), (104, "ｆｕｌｌ"), (105, "a▁"), (106, "\x00")]


@pytest.mark.parametrize("lane,together", [(1024, 4 << 20), (7, 2000)])
def test_against_brute_force(spark, plain, lane, together):
    rows = sample()
    df = alignment.score_links(alignment.align(spark.createDataFrame(rows, DOCS).repartition(3), together=together, long=lane))
    got = {r["id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")) for r in df.collect()}
    want = brute(rows, plain)
    assert sum(w[0] == 0 for w in want.values()) >= 4
    assert got == want


@pytest.mark.parametrize("seed,lane", [(0, 1024), (1, 5), (2, 2), (3, 64)])
def test_lockstep_finds_all_common_ends(seed, lane):
    rng = np.random.default_rng(seed)
    ends, firsts, base = ([], []), ([0], [0]), 0
    for _ in range(30):
        total = int(rng.integers(1, 400))
        for side, most in zip((0, 1), (3, 5), strict=True):
            inner = np.unique(rng.integers(1, total + 1, total // most + 1))
            own = np.unique(np.append(inner, total)) + base
            ends[side].extend(own.tolist())
            firsts[side].append(len(ends[side]))
        base += total
    a, b = (np.array(e) for e in ends)
    a_firsts, b_firsts = (np.array(f) for f in firsts)
    begun = alignment.lanes(a, b, a_firsts[:-1], a_firsts[1:], b_firsts[:-1], lane)
    links_a, links_b = alignment.lockstep(a, b, *begun)
    common = np.intersect1d(a, b)
    assert (a[links_a] == common).all() and (b[links_b] == common).all()
    assert lane > 64 or len(begun[0]) > 30


def test_very_long_texts(plain):
    a, b = alignment.byte_bpe(alignment.A_PATH), alignment.piece_bpe(alignment.B_PATH)
    rng = random.Random(2)
    texts = ["a" * 100_000, " " * 60_000, "ab1" * 20_000, " ".join(str(rng.randrange(10**6)) for _ in range(40_000))]
    ids_a, ids_b = a.encode(texts), b.encode(texts)
    assert ids_a[:3] == [plain[0](t) for t in texts[:3]]
    m = alignment.merge(ids_a, ids_b, a, b)
    ends = [np.cumsum(v.lengths[x]) for v, x in ((a, m.a), (b, m.b))]
    assert (ends[0][m.links_a] == np.intersect1d(*ends)).all()


def test_pairs_stay_within_the_bound_of_the_vocabularies(spark):
    a, b = alignment.byte_bpe(alignment.A_PATH), alignment.piece_bpe(alignment.B_PATH)
    counted = alignment.pair_counts(alignment.align(spark.createDataFrame(sample(), DOCS))).collect()
    for pair, _ in counted:
        x, y = a.tokens[pair >> 32], b.tokens[pair & 0xFFFFFFFF]
        assert x.endswith(y) or y.endswith(x)
    assert len(counted) <= a.lengths.sum() + b.lengths.sum() < 700_000


def test_odd_rows(spark):
    got = alignment.score_links(alignment.align(odd(spark, ["groups", "id", "pair"]))).withColumn("clash", F.lit(1)).collect()
    by_id = {r["id"]: r for r in got}
    assert len(got) == 11
    for i in (1, 2):
        assert by_id[i]["n_a"] == by_id[i]["count_sum"] == 0 and by_id[i]["groups"] == ""
    assert by_id[None]["n_a"] > 0 and by_id[7]["n_links"] > 1000
    assert alignment.score_links(alignment.align(empty(spark))).count() == 0
