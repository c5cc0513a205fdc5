import random
import re
from collections import Counter

import numpy as np
import pytest

from lakemill.llm import collocations

from .cases import empty, odd

DOCS = "doc_id bigint, text string, lang string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least, longest=5, top=2000, subsumed=100):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            counts = f.setdefault(lang, Counter())
            for k in range(1, longest + 1):
                counts.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = []
        often = {p: a for p, a in counts.items() if a >= least}
        for p, a in often.items():
            if len(p) < 2:
                continue
            inside = lambda q, p=p: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= subsumed * a and inside(q) for q, b in often.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "new", "york", "city", "È", "e", "x\x00y", "a-b", "ß", *[f"w{i}" for i in range(30)]]
    weights = [30, 25, 12, 10, 8, 6, 6, 4, 4, 4, *[1] * 30]
    rows = []
    for i in range(150):
        ws = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        if rng.random() < 0.4:
            ws[3:3] = ["new", "York", "city", "of", "light"]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ". ", "\n", "! ", " ;"]) for w in ws)
        rows.append((i, text, rng.choice(["en", "en", "fr", None, "und"])))
    return [*rows, (900, None, "en"), (901, "", "xx"), (902, "of of of of of of of " * 9, "rep"), *[(903, "same words here again", "en")] * 7]


@pytest.mark.parametrize("seed,least,shard,held,bits", [(1, 5, 1 << 21, 1 << 22, 25), (2, 4, 40, 30, 25), (3, 3, 300, 100, 8), (4, 6, 1, 1, 6)])
def test_against_brute_force(spark, seed, least, shard, held, bits):
    rows = sample(seed)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(df, least=least, filter_bits=bits, limits=collocations.Limits(shard, held)).collect())
    want = brute(rows, least)
    assert got == want and len(want) > 40


@pytest.mark.parametrize("subsumed,top,longest", [(60, 7, 5), (100, 2000, 3)])
def test_parameters(spark, subsumed, top, longest):
    rows = sample(8)
    df = spark.createDataFrame(rows, DOCS).repartition(2)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(df, least=4, subsumed=subsumed, top=top, longest=longest).collect())
    assert got == brute(rows, 4, longest, top, subsumed)


@pytest.mark.parametrize("seed,symbols,longest", [(0, 2, 5), (1, 9, 6), (2, 40, 4), (3, 1, 7)])
def test_extension_finds_all_phrases(seed, symbols, longest):
    rng = np.random.default_rng(seed)
    runs = [np.append(rng.integers(1, symbols + 1, rng.integers(1, 30)), 0) for _ in range(40)]
    text = np.concatenate(runs)
    _, text = np.unique(text, return_inverse=True)
    want = Counter()
    for run in np.split(text, np.flatnonzero(text == 0) + 1):
        ws = run[:-1].tolist()
        want.update(tuple(ws[i : i + k]) for k in range(2, longest + 1) for i in range(len(ws) - k + 1))
    got = {}
    for found, counts in collocations.phrases(text, longest):
        for p, c in zip(found.tolist(), counts.tolist(), strict=True):
            assert tuple(p) not in got
            got[tuple(p)] = c
    assert got == want


def test_extension_goes_on_only_with_the_triples_it_is_given():
    text = np.array([1, 2, 3, 1, 2, 3, 1, 0, 2, 3, 1, 2, 0])
    may = lambda t: ~((t == [2, 3, 1]).all(axis=1))
    got = {tuple(p): c for found, n in collocations.phrases(text, 4, may) for p, c in zip(found.tolist(), n.tolist(), strict=True)}
    assert got == {(1, 2): 3, (2, 3): 3, (3, 1): 3, (1, 2, 3): 2, (3, 1, 2): 2, (3, 1, 2, 3): 1}


def test_products_beyond_64_bits(spark):
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n bigint")
    known = spark.createDataFrame([("en", 1, 10**13 + 1), ("en", 2, 10**13 + 3)], "lang string, wid bigint, f bigint")
    found = spark.createDataFrame([([1, 2], 10**13)], "phrase array<bigint>, f bigint")
    (row,) = collocations.score_phrases(totals, known, found).collect()
    assert row["score"] == 1000 * 10**13 * 10**14 // ((10**13 + 1) * (10**13 + 3)) and row["phrase"] == [1, 2]


def test_odd_rows(spark):
    rows = odd(spark, ["n", "phrase", "word"])
    got = collocations.collocations(rows, least=2).collect()
    assert {r["lang"] for r in got} >= {"en"}
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(rows, least=10**6).count() == 0
