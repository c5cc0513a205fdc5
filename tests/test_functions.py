"""Hand-written cases for the small text formats."""

import random
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemill.functions import canonical, minitext, names, scalar, spans
from lakemill.operators import aliases, clean


def value(spark, expr, **columns):
    schema = ", ".join(f"{k} string" for k in columns) or "x string"
    row = spark.createDataFrame([tuple(columns.values()) or (None,)], schema)
    return row.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Toán:2.2,Văn:x,Sử:5", {"Toán": 2.2, "Sử": 5.0}),
        ("", {}),
        (None, {}),
        ("Toán:1,Toán:2", {"Toán": 2.0}),
        ("a:1,b:2:3,c:4", {"a": 1.0}),
        ("b:2:3", {}),
        (" a : 1e2 ,q,\u00a0d\u00a0:3", {"a": 100.0, "d": 3.0}),
        ("a:1d,b:0x1p3,c:", {}),
    ],
)
def test_parse_map(spark, text, want):
    assert value(spark, minitext.parse_map("t"), t=text) == want


def test_parse_map_by_id_drops_unknown_keys(spark):
    assert value(spark, minitext.parse_map_by_id("t", {"Toán": 7}), t="Toán:1,Lạ:3") == {7: 1.0}
    assert value(spark, minitext.parse_map_by_id("t", {}), t="Toán:1") == {}


@pytest.mark.parametrize(
    "text, want",
    [("1.2K", 1200), ("3M", 3_000_000), ("8.7K", 8700), ("15", 15), ("abc", 0), (None, 0), ("K", 0), ("1.5", 0)],
)
def test_magnitude(spark, text, want):
    assert value(spark, scalar.magnitude("t"), t=text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("15-03-2024", datetime(2024, 3, 15)),
        ("5-3-2024", datetime(2024, 3, 5)),
        ("15 Tháng 3, 2024", datetime(2024, 3, 15)),
        ("2 ngày trước", None),
        ("junk", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, want):
    assert value(spark, scalar.parse_date("t"), t=text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("5-3-2024", datetime(2024, 3, 5)),
        ("05/3/2024 10:11", datetime(2024, 3, 5)),
        ("2 ngày trước", datetime(1970, 1, 1)),
        ("junk", None),
    ],
)
def test_parse_comment_time(spark, text, want):
    assert value(spark, scalar.parse_comment_time("t"), t=text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Thứ Hai, 15 Tháng 3, 2024 lúc 10:30", datetime(2024, 3, 15, 10, 30)),
        ("Thứ Hai, 15 Tháng 3", datetime(2025, 3, 15)),
        ("15 Tháng 3, 2024", datetime(2024, 3, 15)),
        ("15 Tháng 13, 2024", None),
        ("Hôm qua", None),
        (None, None),
    ],
)
def test_parse_long_date(spark, text, want):
    assert value(spark, scalar.parse_long_date("t"), t=text) == want


def test_small_ones(spark):
    method = "Xét tuyển kết quả thi THPT năm 2023 (đợt 1)"
    assert value(spark, scalar.strip_year_suffix("t"), t=method) == "Xét tuyển kết quả thi THPT"
    assert value(spark, scalar.strip_dot_zero("t"), t=" 7480201.0") == "7480201"
    assert value(spark, scalar.first_number("t"), t="thang 40.5 điểm") == 40.5
    assert value(spark, scalar.first_number("t"), t="không") is None
    assert value(spark, scalar.path_year("t"), t="s3a://b/điểm/2023/a.csv") == 2023
    assert value(spark, scalar.path_year("t"), t="s3a://b/20234/a.csv") is None
    assert value(spark, scalar.pad_code("t"), t="1") == "01"
    assert value(spark, scalar.null_if_sentinel("t"), t="NaN") is None
    assert value(spark, scalar.words("t"), t=" a\u00a0b\n c ") == ["a", "b", "c"]
    assert value(spark, scalar.words("t"), t="  ") == []
    assert value(spark, minitext.split_labels("t"), t="A| B |None||A") == ["A", "B"]


@pytest.mark.parametrize("number, want", [("0.6", 0.6), ("10.0", 10.0), ("0.0", 0.0), ("9.99", 9.8), ("7.2", 7.2)])
def test_floor_bin(spark, number, want):
    assert value(spark, scalar.floor_bin(F.col("t").cast("double"), "0.2"), t=number) == want


@pytest.mark.parametrize("width", ["0.2", "1", "0.25", "5", "0.0000001"])
def test_floor_bin_by_millionths_and_by_decimals_agree(spark, width):
    from decimal import Decimal

    rng = random.Random(1)
    numbers = [rng.choice([rng.uniform(-20, 20), round(rng.uniform(0, 99_999), rng.randint(0, 8)), rng.randint(-5, 10**7) / 10, rng.uniform(0, 1e12)]) for _ in range(400)]
    numbers += [0.5999999, 0.59999999999, 0.6, -0.2, 99_999.9, 100_000.2, 0.0, 1e-9]
    df = spark.createDataFrame([(n,) for n in numbers], "v double")
    for n, got in df.select("v", scalar.floor_bin("v", width)).collect():
        exact = Decimal(repr(n)).quantize(Decimal("1e-10"), rounding="ROUND_HALF_UP")
        assert got == pytest.approx(float(exact - exact % Decimal(width) - (Decimal(width) if exact < 0 and exact % Decimal(width) else 0)), abs=1e-12), n
    special = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1e30,)], "v double")
    assert [r[0] for r in special.select(scalar.floor_bin("v", width)).collect()] == [None] * 4


def test_floor_bin_is_right_at_every_tenth(spark):
    tenths = spark.range(101).select("id", scalar.floor_bin(F.col("id") / 10, "0.2").alias("bin"))
    for r in tenths.collect():
        assert r["bin"] == (r["id"] - r["id"] % 2) / 10


@pytest.mark.parametrize(
    "tags, text, want",
    [
        ("B-A I-A O B-B", "a b c d", [("A", "a b"), ("B", "d")]),
        ("B-A I-B I-A", "x y z", [("A", "x")]),
        ("I-A", "x", []),
        ("B-A", "x y", []),
        ("B-A B-A", "x y", [("A", "x"), ("A", "y")]),
        ("", "", []),
        (None, None, []),
    ],
)
def test_bio_spans(spark, tags, text, want):
    assert [tuple(e) for e in value(spark, spans.bio_spans("g", "t"), g=tags, t=text)] == want


def test_clean_entities(spark):
    found = value(spark, spans.clean_entities("g", "t"), g="B-Z B-A B-A", t="Bách_khoa.. ... ..x.")
    assert [tuple(e) for e in found] == [("A", "x"), ("Z", "Bách khoa")]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Đại học X (ABC), ", "đại học x abc"),
        ("Trường (cơ sở 2) Y", "trường y"),
        ("Mỏ - Địa chất!?", "mỏ - địa chất"),
        ("A & B", "a b"),
        ("...", ""),
        (None, ""),
    ],
)
def test_normalize_org(spark, text, want):
    assert value(spark, names.normalize_org("t"), t=text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Ngành nghề học Y", "y"),
        ("ngành ngành ngành ngành ngành ngành z", "ngành z"),
        ('học  "Y" ', "y"),
        ("chuyên ngành công nghệ", "công nghệ"),
        ("học", "học"),
        (None, ""),
    ],
)
def test_normalize_maj(spark, text, want):
    assert value(spark, names.normalize_maj("t"), t=text) == want


def test_label_decisions(spark):
    chances = F.array(F.lit(0.5), F.lit(0.6), F.lit(0.9))
    assert value(spark, minitext.labels_above(chances, ["a", "b", "c"])) == "b|c"
    assert value(spark, minitext.labels_above(F.array(F.lit(0.1)), ["a"])) == "None"
    assert value(spark, minitext.best_label(chances, ["a", "b", "c"])) == "c"
    assert value(spark, minitext.multi_hot(F.array(F.lit("b")), F.array(F.lit("a"), F.lit("b")))) == [0, 1]


def test_compose_is_nfc_for_vietnamese(spark):
    letters = [c for c in map(chr, [*range(0x41, 0x250), *range(0x1E00, 0x1F00)]) if unicodedata.is_normalized("NFC", c)]
    rng = random.Random(3)
    texts = [unicodedata.normalize("NFD", c) for c in letters if set(unicodedata.normalize("NFD", c)[1:]) <= set(canonical.MARKS)]
    texts += [rng.choice("aeiouyAEOUdx1 ") + "".join(rng.sample(canonical.MARKS, rng.randint(1, 3))) + rng.choice(["", "n", " ", "\u0301"]) for _ in range(300)]
    texts += ["".join(rng.sample(texts, 6)) for _ in range(100)] + ["", "\u0301", "\u0323a\u0302", "Đại học", "\U0001f600\u0301"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", canonical.compose("t").alias("c"))
    for text, got in df.collect():
        assert unicodedata.normalize("NFC", got) == unicodedata.normalize("NFC", text)
        # Where all marks find their letter, the spelling is NFC's.
        if not set(unicodedata.normalize("NFC", text)) & set(canonical.MARKS):
            assert got == unicodedata.normalize("NFC", text), [hex(ord(c)) for c in text]
    assert value(spark, canonical.compose("t"), t=None) is None


@pytest.mark.parametrize("form", ["NFC", "NFD"])
def test_spellings_of_a_name_meet(spark, form):
    alias_df = spark.createDataFrame([("đại học bách khoa", 0, unicodedata.normalize("NFC", "bách khoa hà nội"), 0)], "grp string, key_ord int, variant string, var_ord int")
    df = spark.createDataFrame([(unicodedata.normalize(form, n),) for n in ("Đại học Bách Khoa", "Trường Bách khoa Hà Nội")], "name string")
    normal = df.withColumn("n", names.normalize_org("name"))
    found = aliases.alias_match(normal, "n", alias_df, aliases.ORG_RULES, "g")
    assert [r["g"] for r in found.collect()] == ["đại học bách khoa"] * 2
    assert clean.dedup_ignore_case(df.unionByName(spark.createDataFrame([("ĐẠI HỌC BÁCH KHOA",)], "name string")), "name").count() == 2
