"""Splits and quality measures of label predictions. Rows are scored in place, then summed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalar import words
from lakemill.functions.spans import scoring_spans

DIGITS = 6


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0)))


def _f1(p: Column, r: Column) -> Column:
    return _ratio(2 * p * r, p + r)


def hash_split(df: DataFrame, key: str, shares: dict[str, int], seed: int = 42, name: str = "split") -> DataFrame:
    """Assign rows to named parts by a hash of their key.

    ``shares`` are percents (70/15/15). The same key always falls in the same part, on
    any cluster and in any order; the shares hold on average.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    place = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(100))
    edge, part = 0, None
    for label, share in shares.items():
        edge += share
        part = F.when(place < edge, F.lit(label)) if part is None else part.when(place < edge, F.lit(label))
    return df.withColumn(name, part)


def evaluate_ner(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Entity precision, recall, F1 over all rows, and the share of right tags.

    A row whose two tag strings differ in length is compared over the shorter one.
    """
    pairs = df.select(words(truth).alias("t"), words(predicted).alias("p"))
    both = pairs.select(
        F.slice("t", F.lit(1), F.least(F.size("t"), F.size("p"))).alias("t"),
        F.slice("p", F.lit(1), F.least(F.size("t"), F.size("p"))).alias("p"),
    )
    rows = both.select(
        scoring_spans(F.col("t")).alias("ts"),
        scoring_spans(F.col("p")).alias("ps"),
        F.size("t").alias("tokens"),
        F.size(F.filter(F.zip_with("t", "p", lambda a, b: a == b), lambda same: same)).alias("right"),
    )
    sums = rows.agg(
        F.sum(F.size(F.array_intersect("ts", "ps"))).alias("hit"),
        F.sum(F.size("ts")).alias("n_true"),
        F.sum(F.size("ps")).alias("n_pred"),
        F.sum("tokens").alias("n_tokens"),
        F.sum("right").alias("n_right"),
    )
    p, r = _ratio(F.col("hit"), F.col("n_pred")), _ratio(F.col("hit"), F.col("n_true"))
    return sums.select(
        F.round(p, DIGITS).alias("precision"),
        F.round(r, DIGITS).alias("recall"),
        F.round(_f1(p, r), DIGITS).alias("f1"),
        F.round(_ratio(F.col("n_right"), F.col("n_tokens")), DIGITS).alias("accuracy"),
    )


def evaluate_multilabel(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per-row precision, recall and F1 of label sets averaged over rows, and exact matches.

    A measure that would divide by zero is 0.
    """
    t, p = F.array_distinct(F.col(truth)), F.array_distinct(F.col(predicted))
    sized = df.select(
        F.size(F.array_intersect(t, p)).alias("hit"), F.size(t).alias("nt"), F.size(p).alias("np")
    )
    # Rows with the same three sizes score alike: count them first, then weight.
    kinds = sized.groupBy("hit", "nt", "np").agg(F.count(F.lit(1)).alias("n"))
    hit, nt, np_ = F.col("hit"), F.col("nt"), F.col("np")
    exact = F.when((hit == nt) & (hit == np_), F.lit(1)).otherwise(F.lit(0))

    def mean(x: Column) -> Column:
        return F.round(F.sum(x.cast("decimal(20,12)") * F.col("n")).cast("double") / F.sum("n"), DIGITS)

    return kinds.agg(
        mean(_ratio(hit, np_)).alias("precision"),
        mean(_ratio(hit, nt)).alias("recall"),
        mean(_ratio(2 * hit, nt + np_)).alias("f1"),
        mean(exact).alias("accuracy"),
    )


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def evaluate_weighted(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Class precision, recall and F1 weighted by true counts, and accuracy.

    Works from the confusion counts, which are as few as there are pairs of labels.
    """
    pairs = confusion(df, truth, predicted)
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("nt"), F.lit(0).cast("bigint").alias("np")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("nt"), F.col("n").alias("np")),
            )
        ).alias("s"),
        F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
    ).select("s.*", "hit")
    # Each pair is listed twice, so a hit is too.
    classes = sides.groupBy("label").agg(
        F.sum("nt").alias("nt"), F.sum("np").alias("np"), (F.sum("hit") / 2).alias("hit")
    )
    p, r = _ratio(F.col("hit"), F.col("np")), _ratio(F.col("hit"), F.col("nt"))

    def weighted(x: Column) -> Column:
        return F.round(F.sum(x.cast("decimal(20,12)") * F.col("nt")).cast("double") / F.sum("nt"), DIGITS)

    return classes.agg(
        weighted(p).alias("precision"),
        weighted(r).alias("recall"),
        weighted(_f1(p, r)).alias("f1"),
        F.round(F.sum("hit") / F.sum("nt"), DIGITS).alias("accuracy"),
    )


def overall_f1(ner: DataFrame, multilabel: DataFrame, weighted: DataFrame) -> DataFrame:
    """Mean of the three heads' F1."""
    each = ner.select("f1").unionByName(multilabel.select("f1")).unionByName(weighted.select("f1"))
    return each.agg(F.round(F.avg("f1"), DIGITS).alias("overall_f1"))
