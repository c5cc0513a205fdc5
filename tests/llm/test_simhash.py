import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lakemill.llm import simhash

from .cases import empty, odd

DOCS = "doc_id bigint, text string"


def fingerprint(text, k=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance):
    """Least id reachable, by all pairs."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def sample(seed):
    rng = random.Random(seed)
    vocabulary = [f"Wörd{i}" if i % 3 else f"w{i}" for i in range(50)]
    rows, originals = [], [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 9, 40, 300]))] for _ in range(25)]
    for i in range(250):
        ws = list(rng.choice(originals))
        for _ in range(rng.choice([0, 0, 1, 2])):
            ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        rows.append((i * 2 - 50, rng.choice([" ", "\t", "\n  "]).join(ws)))
    return rows + [(5_000, None), (5_001, ""), (5_002, " \t ")]


@pytest.mark.parametrize("seed,k,distance,block", [(1, 3, 2, 4096), (2, 3, 2, 2), (3, 2, 0, 4096), (4, 3, 1, 3), (5, 5, 4, 5), (6, 3, 7, 4096)])
def test_against_brute_force(spark, seed, k, distance, block):
    rows = sample(seed)
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.link_by_simhash(df, shingle=k, distance=distance, block=block).collect()}
    prints = {i: fingerprint(t, k) for i, t in rows}
    least = classes(prints, distance)
    assert got == {i: (f"{prints[i]:016x}", least[i]) for i in prints}


@pytest.mark.parametrize("distance,block", [(2, 4096), (2, 8), (3, 20), (5, 16)])
def test_crowded_ball_loses_no_link(spark, distance, block):
    rng = random.Random(distance)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 700:
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(14), rng.randint(1, 9))))
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.close_links(spark.createDataFrame([(p,) for p in signed], "print bigint").repartition(5), distance, block).collect()
    for a, b in links:
        assert a in signed and b in signed
    from lakemill.llm.components import components

    groups = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()} if links else {}
    want = classes(dict(zip(signed, [p % (1 << 64) for p in signed], strict=True)), distance)
    assert {p: groups.get(p, p) for p in signed} == want


def test_manhattan_never_exceeds_hamming():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 63, (2, 500), dtype=np.uint64)
    b[::2] = a[::2] ^ (np.uint64(1) << rng.integers(0, 63, 250, dtype=np.uint64))
    far = np.abs(simhash.segment_counts(a).astype(int) - simhash.segment_counts(b).astype(int)).sum(axis=1)
    assert (far <= np.bitwise_count(a ^ b)).all()


def test_very_long_text_and_long_words():
    rng = random.Random(9)
    texts = [" ".join(str(rng.randrange(900)) for _ in range(300_000)), "x" * 100_000, "A b" + "\n" * 9, None, "y " * 700]
    got = simhash.fingerprints(pa.array(texts, pa.string()))
    assert [int(g) for g in got] == [fingerprint(t) for t in texts]


def test_odd_rows(spark):
    got = simhash.link_by_simhash(odd(spark, ["print", "root", "cell"])).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 11 and got[0].asDict().keys() == {"doc_id", "fingerprint", "component_id"}
    assert [by_id[i]["component_id"] for i in (1, 2, 3, 4, 5)] == [1, 1, 1, 4, 4]
    assert by_id[1]["fingerprint"] == "0" * 16 and by_id[None]["component_id"] is None
    assert simhash.link_by_simhash(empty(spark)).count() == 0
