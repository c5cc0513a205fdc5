import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from lakemill.llm import chat, sketches

from .cases import empty, odd, words


def test_equal_texts_have_equal_sketches_and_edits_stay_near(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, 400, "abcdefghijklmnop")) for i in range(60)] + [(100, None), (101, ""), (102, "one two")]
    rows += [(200, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in sketches.edit_likeness(df).collect()}
    assert got[0]["fingerprint"] == got[200]["fingerprint"] != ""
    assert got[100]["fingerprint"] == got[101]["fingerprint"] == ""
    assert got[102]["fingerprint"] != ""
    ordered = sorted(rows, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        m = len(text) // 3
        assert got[i]["edited_sha256"] == hashlib.sha256((text[: len(text) - m] + after[:m]).encode()).hexdigest()
        assert got[i]["n_chars"] == len(text)
    plain = [got[i] for i in range(60)]
    assert sum(r["near_edited"] for r in plain) / 60 == pytest.approx(2 / 3, abs=0.08)
    assert max(r["near_next"] for r in plain if r["doc_id"] != 0) < 0.1


def test_next_row_over_many_ranges(spark):
    ids = random.Random(2).sample(range(-500, 5000), 700)
    df = spark.createDataFrame([(i, f"t{i}", i) for i in ids], "id bigint, text string, tie bigint").repartition(5)
    got = {r["id"]: r["next_text"] for r in sketches.with_next(df, "id", "tie", ["text"], bucket_rows=50).collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"t{j}" for i, j in zip(down, down[1:] + down[:1], strict=True)}


def test_sketch_keeps_exactly_the_low_hashes_and_merges(spark):
    rng = random.Random(3)
    a, b = words(rng, 300), words(rng, 500)
    df = spark.createDataFrame([(a, b)], "a string, b string")
    both = df.select(
        sketches.shingle_hashes(F.col("a")).alias("h"), sketches.sketch(F.col("a"), one_in=8).alias("s"), sketches.sketch(F.col("b"), one_in=8).alias("t")
    ).withColumn("m", sketches.merge(F.col("s"), F.col("t"), one_in=8)).first()
    below = -(1 << 63) + (1 << 61)
    assert len(both["h"]) == 296
    assert both["s"] == sorted({x for x in both["h"] if x < below})
    assert both["m"] == sorted(set(both["s"]) | set(both["t"]))


def test_next_row_where_one_id_has_a_third_of_the_rows(spark):
    rng = random.Random(5)
    tie = lambda: rng.randrange(-(1 << 63), 1 << 63)
    rows = [(i, tie()) for i in range(300)] + [(None, tie()) for _ in range(300)] + [(150, tie()) for _ in range(200)]
    rows += [(150, rows[-1][1])] * 2
    rows = [(i, t, f"{i}:{t}") for i, t in rows]
    df = spark.createDataFrame(rows, "id bigint, tie bigint, text string").repartition(5)
    plain = df.select(F.coalesce("id", F.lit(-(1 << 63))).alias("__k"))
    assert sketches._bounds(plain, 20)[1]
    down = [r[2] for r in sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1]))]
    got = [(r["text"], r["next_text"]) for r in sketches.with_next(df, "id", "tie", ["text"], bucket_rows=20).collect()]
    assert sorted(got) == sorted(zip(down, down[1:] + down[:1], strict=True))


def plain_sketch(text, k=5, one_in=sketches.ONE_IN):
    """Hashes of word runs by the public hash function, each word's seeded with the hash so far."""
    ws = text.lower().split()
    runs = [ws[i : i + k] for i in range(max(len(ws) - k + 1, min(len(ws), 1)))]
    found = set()
    for run in runs:
        h = 42
        for w in run:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        found.add(h - (1 << 64) if h >> 63 else h)
    low = {h for h in found if h < -(1 << 63) + (1 << 64) // one_in}
    return low or set(sorted(found)[:1])


def plain_likeness(a, b):
    a, b = plain_sketch(a), plain_sketch(b)
    return 1.0 if not a and not b else len(a & b) / min(len(a), len(b)) if a and b else 0.0


def test_likeness_against_plain_hashes(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.choice([0, 1, 4, 5, 6, 12, 40, 300]), "abcd")) for i in range(80)] + [(90, None), (91, "x" * 9 + " y")]
    got = {r["doc_id"]: r for r in sketches.edit_likeness(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        hexed = lambda t: "".join(f"{h & (1 << 64) - 1:016x}" for h in sorted(plain_sketch(t)))
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (hexed(text), hexed(edited))
        assert got[i]["near_edited"] == pytest.approx(plain_likeness(text, edited))
        assert got[i]["near_next"] == pytest.approx(plain_likeness(text, after))


def test_short_texts_are_found_in_long_ones(spark):
    rng = random.Random(8)
    long_texts = [words(rng, 300, "abcdefghijklmnop") for _ in range(200)]
    rows = [(" ".join(t.split()[50:62]), t) for t in long_texts]
    both = spark.createDataFrame(rows, "a string, b string")
    near = [r["x"] for r in both.select(sketches.containment(sketches.sketch(F.col("a")), sketches.sketch(F.col("b"))).alias("x")).collect()]
    assert sum(x == 1.0 for x in near) >= 195


def test_sketches_of_odd_rows(spark):
    got = sketches.edit_likeness(odd(spark, ["sketch", "tie"])).collect()
    assert len(got) == 11
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert sketches.edit_likeness(empty(spark)).count() == 0
    one = sketches.edit_likeness(spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id bigint, text string")).first()
    assert one["near_next"] == 1.0


TURNS = "conv_id bigint, turn bigint, role string, text string"
NASTY = ["", "\\", "\\\\", "###", "### assistant:\n", "\n</turn>\n", "</turn>", "a\\### b", "<<\\<", "é \U0001f600\n\n", "x" * 5000]


@pytest.mark.parametrize("text", NASTY)
def test_escaping_is_reversible(text):
    piece = chat.header("a:b\\#<\n" + text) + chat.escape(text) + chat.TAIL
    assert chat.unescape(chat.escape(text)) == text
    assert chat.parse_piece(piece) == ("a:b\\#<\n" + text, text)
    assert "</turn>" not in chat.escape(text).replace("\\<", "") and "###" not in chat.escape(text).replace("\\#", "")


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        reply = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(reply), hashlib.sha256(reply.encode()).hexdigest())
    return out


def test_conversations_round_trip(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(NASTY)) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", None), (None, 1, "assistant", "for no one"), (50, 3, None, None), (51, 1, "user", "tie"), (51, 1, "assistant", "tie")]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(3000)]
    df = spark.createDataFrame(rows, TURNS).withColumn("piece", F.lit("clash")).repartition(6)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == expected([(c, t, r, x) for c, t, r, x in rows])


def test_each_reply_is_one_example_with_all_turns_before_it(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "### there"), (1, 4, "user", "left over")]
    pieces = chat.format_turns(spark.createDataFrame(rows, TURNS))
    got = sorted(chat.render(pieces, chat.examples(pieces)).collect(), key=lambda r: r["target_turn"])
    assert [r["target_turn"] for r in got] == [1, 3]
    for r, reply, turns in zip(got, ("hello", "### there"), (2, 4), strict=True):
        assert chat.unescape(r["text"][r["loss_start"] : r["loss_end"]]) == reply
        assert r["text"].count(chat.TAIL) == turns
    assert got[1]["text"].startswith(got[0]["text"])
    told = chat.read_back(pieces).first()
    made = chat.examples(pieces).collect()
    assert [chat.unescape(r["reply"]) for r in made] == ["hello", "### there"]
    assert (told["n_examples"], told["example_chars"]) == (2, sum(len(r["text"]) for r in got))
    silent = chat.read_back(chat.format_turns(spark.createDataFrame([(3, 0, "user", "alone")], TURNS))).first()
    assert (silent["loss_chars"], silent["n_examples"], silent["loss_sha256"]) == (0, 0, hashlib.sha256(b"").hexdigest())
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], TURNS))).count() == 0
