import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import language, queries_free, toxicity
from lakemill.llm.registry import table

from ..conftest import SMALL
from .cases import empty, odd

LARGER = SMALL.replace("sf0.001", "sf0.01")


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def longest_first(text, train):
    """Phrases of a text: each the longest match with the training text, or a single symbol."""
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in train:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases_against_search():
    texts = {"en": ["the cat sat on the mat", "then there was a hat"], "de": ["die katze saß auf der matte", "dann war da ein hut"]}
    model = language.build(texts)
    tests = ["the hat was on a mat", "Der Hut war auf der Katze!", "q", "zzz the zzz", "...", "", "a--b", "the " * 1500]
    letters, phrases = language.parse(tests, model)
    for i, lang in enumerate(model.langs):
        train = "".join(map(chr, language.symbols(" ".join(texts[lang]).lower(), model.codes)))
        for j, text in enumerate(tests):
            codes = "".join(map(chr, language.symbols(text.lower(), model.codes)))
            want = sum(longest_first(codes[a : a + language.STRETCH], train) for a in range(0, len(codes), language.STRETCH))
            assert phrases[i, j] == want, (lang, text)
    assert letters.tolist() == [sum(c.isalpha() for c in t.lower()) for t in tests]
    judged = language.judge(tests, model)[0]
    assert (judged[0], judged[1], judged[4], judged[5]) == ("en", "de", "und", "und")


def test_automaton_holds_exactly_the_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2, 1]
    go = language.automaton(text)
    subs = {tuple(text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1)}

    def walk(state, path):
        for c, to in go[state].items():
            yield (*path, c)
            yield from walk(to, (*path, c))

    assert set(walk(0, ())) == subs


def test_language_of_held_out_documents(spark):
    got = queries_free.language_id(spark, LARGER).join(table(spark, LARGER, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == table(spark, LARGER, "documents").count()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97


def test_language_of_odd_rows(spark):
    model = language.build({"en": ["one text is this"], "fr": ["un texte est ici"]})
    got = language.identify(odd(spark, ["score", "lang_pred"]), model).collect()
    assert len(got) == 11
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert {r["lang_pred"] for r in got if r["doc_id"] in (4, 7, 8)} <= {"en", "fr"}
    assert language.identify(empty(spark), model).count() == 0
    nobody = language.fit(empty(spark), ~queries_free.held_out("doc_id"))
    assert {r["lang_pred"] for r in language.identify(odd(spark), nobody).collect()} == {"und"}


def test_toxic_words_are_learned():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(1500):
        label = int(rng.random() < 0.2)
        places = np.unique(rng.integers(1000, 1 << 18, 40))
        rows.append((label, np.append(places, rng.integers(0, 5)) if label else places))
    model = toxicity.ftrl(rows)
    assert set(range(5)) <= set(model.places.tolist())
    assert (model.weights[np.isin(model.places, range(5))] > 1).all()
    assert len(model.places) < 2_000


def test_toxicity_of_held_out_documents(spark):
    bigger = SMALL.replace("sf0.001", "sf0.1")
    labels = table(spark, bigger, "labels").select("doc_id", "toxic")
    got = queries_free.toxic_scores(spark, bigger).join(labels, "doc_id").filter("held_out and toxic is not null").collect()
    caught = [r["predicted"] for r in got if r["toxic"] == 1]
    blamed = [r["predicted"] for r in got if r["toxic"] == 0]
    assert sum(caught) / len(caught) > 0.8
    assert sum(blamed) / len(blamed) < 0.01
    assert all(held(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 0), (5, 1), (5, 1), (9, None), (None, 1), (77, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd(spark), labels, "doc_id", "text", "toxic", ~queries_free.held_out("lid"))
    got = toxicity.score(odd(spark, ["score", "predicted"]), model).collect()
    assert len(got) == 11
    assert all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.fit(empty(spark), labels.limit(0), "doc_id", "text", "toxic", ~queries_free.held_out("lid"))
    assert {r["score"] for r in toxicity.score(odd(spark), none).collect()} == {0.5}
    assert toxicity.score(empty(spark), model).count() == 0


@pytest.mark.parametrize("gap", [1, 2])
def test_skip_grams_stay_in_their_text(gap):
    data = np.frombuffer(b"a b c" + b"d e", dtype=np.uint8)
    places, rows = toxicity.features(data, np.array([0, 5, 8]))
    assert np.bincount(rows).tolist() == [3 + 2 + 1, 2 + 1]


@pytest.mark.parametrize("one_id", [None, 4])
def test_a_hot_id_brings_one_text_to_the_driver(spark, monkeypatch, one_id):
    texts = [(one_id, f"ceci est un texte numéro {i} " * 3, "fr") for i in range(300)] + [(100 + i, f"this is text number {i} " * 3, "en") for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").repartition(4)
    taken = []
    real = language.build
    monkeypatch.setattr(language, "build", lambda samples: (taken.append(samples), real(samples))[1])
    language.fit(df, F.lit(True))
    assert len(taken[0]["fr"]) == 1 and len(taken[0]["en"]) == 40
    if one_id is not None:
        labels = spark.createDataFrame([(one_id, 1)] + [(100 + i, 0) for i in range(40)], "doc_id bigint, toxic int")
        fitted = []
        monkeypatch.setattr(toxicity, "ftrl", lambda examples, bits: fitted.extend(examples))
        toxicity.fit(df, labels, "doc_id", "text", "toxic", F.lit(True))
        assert len(fitted) == 41
