from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakemill.llm import lines, mixing

from .cases import empty, odd


def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    shared = {k: max(h) for k, h in holders.items() if len(k) >= min_chars and len(h) >= min_docs}
    out = {}
    for i, text in rows:
        all_lines = (text or "").split("\n")
        left = [x for x in all_lines if shared.get(key(x), i) == i]
        out[i] = (len(all_lines), len(all_lines) - len(left), "\n".join(left))
    return out


def test_lines_against_brute_force(spark):
    common = ["All rights reserved, every one of them", "\tALL RIGHTS reserved, every one of them ", "short", "Été comme hiver, É reste É ici"]
    rows = [(i, "\n".join([common[i % 2], common[2], f"line of its own {i}", *([common[3]] * (i % 3))])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, common[0] + "\n" + common[0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in lines.drop_shared_lines(df).collect()}
    assert got == brute_lines(rows)


def test_line_threshold_counts_documents_not_lines(spark):
    line = "a line that is long enough"
    df = spark.createDataFrame([(1, f"{line}\n{line}\n{line}"), (2, line)], "doc_id bigint, text string")
    assert lines.drop_shared_lines(df).agg(F.sum("n_dropped")).first()[0] == 0


def test_a_text_of_very_many_shared_lines_takes_time_in_proportion(spark):
    text = "\n".join(f"a line that is long enough, number {i}" for i in range(100_000))
    rows = [(i, f"{text}\nline {i}") for i in range(3)]
    got = {r["doc_id"]: r for r in lines.drop_shared_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i]["n_dropped"] for i in range(3)] == [100_000, 100_000, 0]
    assert (got[0]["kept_text"], got[2]["kept_text"]) == ("line 0", rows[2][1])


def test_lines_of_odd_rows(spark):
    got = lines.drop_shared_lines(odd(spark, ["kept_text", "n_lines"])).collect()
    assert len(got) == 11
    assert {r["n_lines"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert lines.drop_shared_lines(empty(spark)).count() == 0


def test_mix_is_near_its_targets_and_agrees_with_itself(spark):
    rows = [(i, "w " * (1 + i * 7 % 300), f"s{i % 7}" if i % 50 else None) for i in range(3000)]
    rows += [(10_000, "x " * 9, "tiny")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(df, keep=("source",)).collect()
    again = mixing.mix(df.repartition(7), keep=("source",)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert len(got) == len(rows)
    total = sum(r["size"] for r in got)
    taken, target, size = Counter(), {}, {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert sum(target.values()) == pytest.approx(total)
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(2, 0.002 * t)
        assert t <= 3 * size[s] + 1e-6
    assert target["tiny"] == 27.0


def brute_fill(sizes, weights, epochs=3):
    total, held = sum(sizes), set()
    while True:
        rest = total - sum(epochs * sizes[i] for i in held)
        w = sum(weights[i] for i in range(len(sizes)) if i not in held)
        new = {i for i in range(len(sizes)) if i not in held and epochs * sizes[i] * w < weights[i] * rest}
        if not new:
            return [epochs * s if i in held else weights[i] * rest / w for i, s in enumerate(sizes)]
        held |= new


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 1000, 3, 0], [5], [0, 0], [1, 2, 4, 8, 16, 1 << 40]])
def test_water_filling_against_brute_force(spark, sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    df = spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))], "i int, source_size bigint, weight int")
    got = [r["target"] for r in mixing.water_fill(df).orderBy("i").collect()]
    assert got == pytest.approx(brute_fill(sizes, weights))


def test_mix_of_odd_rows(spark):
    got = mixing.mix(odd(spark, ["size", "target"]), keep=("text", "size", "target")).collect()
    assert len(got) == 11
    assert all(r["taken"] == 0 for r in got if not (r["text"] or "").strip())
    assert mixing.mix(empty(spark)).count() == 0
