import random
import re

import pytest

from lakemill.llm import contamination as C

from .cases import empty, odd

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        ws = words(text)
        n = min(13, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        ws, hit, named = words(text), set(), set()
        for n in sizes:
            for at in range(len(ws) - n + 1):
                found = windows.get(tuple(ws[at : at + n]))
                if found:
                    hit |= set(range(at, at + n))
                    named |= found
        out[i] = (len(ws), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(ws))
    return out


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "a", "Öl", "x1", "été", "日本", "ab", "cd", "ef"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([30, 13, 14, 50, 13, 5, 1, 3, 0])] + [(20, None), (21, "the the " * 20)]
    items += [(30, items[0][1]), (30, items[1][1])]
    docs = []
    for i in range(150):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            own = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(own) - 8))
            parts += [" ".join(own[a : a + rng.randint(8, 20)]), text(rng.randint(0, 60))]
        docs.append((i, rng.choice([" ", ", ", "--"]).join(parts).upper() if i % 5 == 0 else " ".join(parts)))
    return docs + [(900, None), (901, ""), (902, "the"), (903, "the " * 200)], items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 1 << 20), (3, 300)])
def test_against_brute_force(spark, seed, block):
    docs, items = sample(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = C.mark_contamination(df, bench, block_bytes=block).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in got} == brute(docs, items)


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_odd_rows(spark, block):
    bench = spark.createDataFrame([(1, "one"), (2, "a text whose id"), (3, "")], "item_id bigint, text string")
    got = C.mark_contamination(odd(spark, ["hits", "n_words"]), bench, block_bytes=block)
    assert sorted((r["doc_id"] for r in got.filter("contaminated").collect()), key=str) == [4, 5, 5, None]
    assert got.count() == 11
    assert C.mark_contamination(empty(spark), bench).count() == 0
    assert C.mark_contamination(odd(spark), bench.limit(0)).filter("contaminated").count() == 0


def test_long_text_spans_stretches(spark):
    item = " ".join(f"w{i}" for i in range(20))
    filler = " ".join(f"v{i % 977}" for i in range(1_200_000))
    df = spark.createDataFrame([(1, filler + " " + item)], "doc_id bigint, text string")
    got = C.mark_contamination(df, spark.createDataFrame([(1, item)], "item_id bigint, text string")).select("n_words", "n_hit", "contaminated").first()
    assert tuple(got) == (1_200_020, 20, False)
