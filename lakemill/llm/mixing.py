"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.bounds import checked_broadcast
from lakemill.operators.keys import surrogate_key
from lakemill.session import cut

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BANDS = 1024
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"
WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded(id_col: Column, seed: int, step: str) -> Column:
    """A number in [0, 1) from the seed and the document's id: 40 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{step}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 10), 16, 10).cast("double") / F.lit(float(1 << 40))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to sources (source_size, weight); the targets share the sum of all sizes.

    A source whose share would pass ``max_epochs`` times its size is clamped there, and
    what it leaves is shared among the others by weight, until no share is above its cap.
    Each round is one aggregate over the sources; only three sums reach the driver, and
    what they say about a source is exact whole-number arithmetic. A round that clamps
    no further source is the last, so there are at most as many rounds as sources; the
    level only rises, and in practice a few rounds do.
    """
    size, weight = F.col("source_size").cast(WIDE), F.col("weight").cast(WIDE)
    total = sources.agg(F.coalesce(F.sum(size), F.lit(0).cast(WIDE)).alias("t")).first()["t"]
    rest, weights = int(total), None
    clamped = F.lit(False)
    while True:
        sums = sources.agg(
            F.sum(F.when(clamped, size * max_epochs)).cast(WIDE).alias("held"),
            F.sum(F.when(~clamped, weight)).cast(WIDE).alias("w"),
            F.count_if(clamped).alias("n"),
        ).first()
        if weights is not None and sums["n"] == n_clamped:
            break
        rest, weights, n_clamped = int(total) - int(sums["held"] or 0), int(sums["w"] or 0), sums["n"]
        # size × epochs < rest × weight / weights, in whole numbers
        clamped = size * F.lit(max_epochs * weights).cast(WIDE) < weight * F.lit(rest).cast(WIDE)
    share = (weight * F.lit(rest).cast(WIDE)).cast("double") / F.lit(float(weights or 1))
    return sources.withColumn("target", F.when(clamped, (size * max_epochs).cast("double")).otherwise(share))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """id, ``size``, ``source_size``, ``target`` and ``taken`` of every document, and the columns ``keep``.

    ``size`` counts words. Sources in code point order, null last, have the weights in
    turn. With target / source_size = whole + part epochs, each document is taken ``whole``
    times; for the part, documents follow in seeded hash order, cut into bands, and bands
    are taken from the first on until the part is reached. Documents of the band in which
    that happens give a part of their words, rounded by a seeded draw. So a source's taken
    words differ from its target by no more than that rounding, no document is taken more
    than ``max_epochs`` times, and reruns agree, as nothing depends on partitions.

    Hot source: sizes are summed on the map side by source and band, and there are at most
    ``BANDS`` rows of a source in the window; the rows get their source's figures by a
    broadcast only if the sources are few, else by a join that Spark can split.

    The input is read twice, so it should be a stored table; nothing of it is written.

    Null text: size 0, taken 0. Null source: a source of its own. Null ids and repeated
    ids: taken alike, as the draws depend on the id alone. A source without words: target
    0. Empty table: empty result. Other columns are ignored unless in ``keep``; those named
    like a result are replaced.
    """
    keep = tuple(c for c in keep if c not in (id_col, "size", "source_size", "target", "taken"))
    sized = docs.select(
        F.col(id_col).alias("__id"),
        F.col(source_col).alias("__source"),
        word_count(F.col(text_col)).alias("size"),
        F.floor(seeded(F.col(id_col), seed, "band") * BANDS).cast("int").alias("__band"),
        seeded(F.col(id_col), seed, "draw").alias("__draw"),
        *[F.col(c).alias(f"__keep_{c}") for c in keep],
    )
    bands = cut(sized.groupBy("__source", "__band").agg(F.sum("size").alias("words")))
    sources = bands.groupBy("__source").agg(F.sum("words").alias("source_size"))
    numbered = surrogate_key(
        sources.withColumn("__last", F.col("__source").isNull()), "__no", ["__last", "__source"], start=0
    )
    turn = F.array(*[F.lit(w) for w in weights])
    plan = water_fill(numbered.withColumn("weight", F.get(turn, (F.col("__no") % len(weights)).cast("int"))), max_epochs)
    # The words before a band tell whether the part epoch ends in it.
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("__whole", F.least(F.floor(epochs), F.lit(max_epochs))).withColumn(
        "__part", F.greatest(F.col("target") - F.col("__whole") * F.col("source_size"), F.lit(0.0))
    )
    before = Window.partitionBy("__source").orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    placed = bands.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    plan = plan.select(F.col("__source").alias("__s"), "source_size", "target", "__whole", "__part")
    reach = placed.join(plan, F.col("__source").eqNullSafe(F.col("__s"))).withColumn(
        "__open", (F.col("words") > 0) & (F.col("before") < F.col("__part")) & (F.col("before") + F.col("words") > F.col("__part"))
    )
    ends = reach.groupBy("__s", "source_size", "target", "__whole").agg(
        F.max(F.when(F.col("before") < F.col("__part"), F.col("__band"))).alias("__end"),
        F.max(F.when(F.col("__open"), (F.col("__part") - F.col("before")) / F.col("words"))).alias("__share"),
    )
    ends = cut(ends)
    # A band below the last one is taken whole; an open last band gives its share.
    extra = (
        F.when(F.col("__band") < F.col("__end"), F.col("size"))
        .when((F.col("__band") == F.col("__end")) & F.col("__share").isNull(), F.col("size"))
        .when(F.col("__band") == F.col("__end"), F.floor(F.col("size") * F.col("__share") + F.col("__draw")))
        .otherwise(F.lit(0))
    )
    taken = F.least(F.col("__whole") * F.col("size") + extra, F.col("size") * max_epochs)
    return sized.join(checked_broadcast(ends), F.col("__source").eqNullSafe(F.col("__s"))).select(
        F.col("__id").alias(id_col),
        *[F.col(f"__keep_{c}").alias(c) for c in keep],
        "size",
        "source_size",
        "target",
        taken.cast("bigint").alias("taken"),
    )
