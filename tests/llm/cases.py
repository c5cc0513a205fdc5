"""Documents with nulls, empty and very long texts, ties, repeated rows and columns whose names clash."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    rng = random.Random(7)
    long_text = words(rng, 30_000)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", None, 4),
        (4, "one", "en", "a", 3),
        (5, "one", "fr", "a", 3),
        (5, "one", "fr", "a", 3),
        (None, "a text whose id is null", "en", "b", 23),
        (7, long_text, "en", "b", len(long_text)),
        (8, long_text + " end", "en", "b", len(long_text) + 4),
        (9, "Éİ \U0001f600 ß\x00 ſecret", None, "c", 12),
        (-3, "negative id", "de", "", 11),
    ]
    return rows


def odd(spark, clash=()):
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    for name in clash:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("old"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
