"""Document fingerprints: every shingle hash below a fixed fraction of the hash range."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.lines import BLANKS, let

SHINGLE = 5
#: A text of n shingles has none below the fraction with odds of 1 in 2^n, so short texts, too, can be found in long ones.
ONE_IN = 2
BUCKET_ROWS = 20_000
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def words_of(text: Column) -> Column:
    """Lower-case words between blanks; none for null or blank text."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    """One hash for each run of ``k`` words; a shorter text is one shingle, an empty one has none."""

    def hashes(ws: Column) -> Column:
        n = F.greatest(F.size(ws) - (k - 1), F.least(F.size(ws), F.lit(1)))
        return F.transform(F.slice(ws, F.lit(1), n), lambda _, i: F.xxhash64(*[F.get(ws, i + j) for j in range(k)]))

    return let(words_of(text), hashes)


def sketch(text: Column, k: int = SHINGLE, one_in: int = ONE_IN) -> Column:
    """Sorted distinct hashes in the lowest 1/``one_in`` of the range.

    A text with shingles but no such hash keeps its smallest, so that it is not blank.
    """
    below = F.lit(_LOWEST + (1 << 64) // one_in)
    return let(
        shingle_hashes(text, k),
        lambda h: let(
            F.array_sort(F.array_distinct(F.filter(h, lambda x: x < below))),
            lambda low: F.when((F.size(low) > 0) | (F.size(h) == 0), low).otherwise(F.array(F.array_min(h))),
        ),
    )


def merge(left: Column, right: Column, one_in: int = ONE_IN) -> Column:
    """Sketch of two texts together: the union, without hashes kept only for want of smaller ones."""
    below = F.lit(_LOWEST + (1 << 64) // one_in)
    return let(
        F.array_sort(F.array_union(left, right)),
        lambda u: let(
            F.filter(u, lambda x: x < below), lambda low: F.when((F.size(low) > 0) | (F.size(u) == 0), low).otherwise(F.slice(u, 1, 1))
        ),
    )


def containment(left: Column, right: Column) -> Column:
    """Estimated part of the smaller text's shingles found in the other; 1 for two empty texts, 0 for one."""
    least = F.least(F.size(left), F.size(right))
    return (
        F.when((F.size(left) == 0) & (F.size(right) == 0), F.lit(1.0))
        .when(least == 0, F.lit(0.0))
        .otherwise(F.size(F.array_intersect(left, right)) / least)
    )


def as_text(hashes: Column) -> Column:
    """16 hex digits a hash, in order."""
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def fingerprints(docs: DataFrame, text_col: str = "text", k: int = SHINGLE, one_in: int = ONE_IN) -> DataFrame:
    """``docs`` with ``sketch``, an array of longs, added (a column of that name is replaced).

    Null text counts as empty and has an empty sketch. Equal texts have equal sketches.
    Each row stands alone: no shuffle, ties and repeated rows need no rule, an empty table
    stays empty.
    """
    return docs.withColumn("sketch", sketch(F.col(text_col), k, one_in))


def _bounds(ids: DataFrame, bucket_rows: int) -> tuple[list[int], dict[int, int]]:
    """Lower bounds of the id ranges, and into how many parts an id that fills more than one range is cut."""
    n = ids.count()
    parts = max(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // bucket_rows))
    if n == 0 or parts < 2:
        return [], {}
    points = [i / parts for i in range(1, parts)]
    found = Counter(ids.agg(F.percentile_approx("__k", points, max(10_000, 20 * parts))).first()[0])
    hot = {k: times + 1 for k, times in found.items() if times > 1}
    return sorted({*found, *(k + 1 for k in hot if k < _HIGHEST)}), hot


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most the key, by halving."""
    if not bounds:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    reach = lambda at, step: F.when(F.get(array, at + step - 1) <= key, at + step).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), reach)


def with_next(docs: DataFrame, id_col: str, tie_col: str, carry: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``next_<c>`` for each column of ``carry``: its value in the next row by descending id.

    After the last row comes the first. Rows are dealt into id ranges of about
    ``bucket_rows`` rows whose bounds come from an approximate quantile of the id column
    alone, and each range is one window; the first row of the following range is added to
    it for the time being. An id that fills several ranges is cut by ``tie_col`` into as many. So no task
    sees all rows, and texts are shuffled once. Null ids come last; rows with one id are ordered
    by ``tie_col``, a bigint spread over its whole range, such as a hash. Rows equal in both meet in
    one range. One row: its own successor.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col), F.lit(_LOWEST))
    bounds, hot = _bounds(docs.select(key.alias("__k")), bucket_rows)
    placed = docs.withColumn("__k", key).withColumn("__b", _bucket(F.col("__k"), bounds))
    if hot:  # fewer ids than ranges
        cuts = F.broadcast(spark.createDataFrame(list(hot.items()), "__hot bigint, __parts int"))
        share = F.floor((F.col(tie_col) / F.lit(float(1 << 64)) + 0.5) * F.col("__parts")).cast("int")
        part = F.coalesce(F.least(share, F.col("__parts") - 1), F.lit(0))
        placed = placed.join(cuts, F.col("__k") == F.col("__hot"), "left").withColumn("__p", part)
        # The first of a part is known by its tie; of any other range all rows of the largest id come along.
        first = F.min(F.when(F.col("__hot").isNotNull(), F.col(tie_col)))
        placed = placed.drop("__parts")
    else:
        placed, first = placed.withColumn("__p", F.lit(0)), F.lit(None).cast("bigint")
    # One row per range: the largest id of each.
    tops = placed.groupBy("__b", "__p").agg(F.max("__k").alias("k"), first.alias("t")).collect()
    tops.sort(key=lambda r: (-r["__b"], r["__p"]))
    following = tops[1:] + tops[:1]
    moves = [(after["k"], after["t"], now["__b"], now["__p"]) for now, after in zip(tops, following, strict=True)]
    placed = placed.drop("__hot")
    rows = placed.withColumn("__guest", F.lit(False))
    if moves:
        heads = F.broadcast(spark.createDataFrame(moves, "__head bigint, __head_tie bigint, __to int, __to_part int"))
        met = (F.col("__k") == F.col("__head")) & (F.col("__head_tie").isNull() | (F.col(tie_col) == F.col("__head_tie")))
        guests = placed.join(heads, met).withColumn("__b", F.col("__to")).withColumn("__p", F.col("__to_part"))
        guests = guests.dropDuplicates(["__b", "__p", tie_col]).drop("__head", "__head_tie", "__to", "__to_part")
        rows = rows.unionByName(guests.withColumn("__guest", F.lit(True)))
    order = Window.partitionBy("__b", "__p").orderBy("__guest", F.col("__k").desc(), F.col(tie_col))
    for c in carry:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    return rows.filter(~F.col("__guest")).drop("__k", "__b", "__p", "__guest")


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of an edited one, and how alike they and neighbours are.

    Edited text: the last third (rounded down) of the code points replaced by the first as
    many (or all) of the next document by descending id; after the last comes the first.
    Null text counts as empty. Repeated ids are ordered by a hash of the text. Only the two
    named columns are used, under names of this function's own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    both = with_next(fingerprints(own), "id", "tie", ["text", "sketch"])
    n = F.length("text")
    cut_at = F.floor(n / 3).cast("int")
    edited = both.withColumn("n_chars", n.cast("bigint")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - cut_at), F.substring("next_text", F.lit(1), cut_at))
    )
    done = edited.select(
        "id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_sketch")
    )
    return done.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
