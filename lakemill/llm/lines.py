"""Line dedup: lines that many documents share are dropped, all but one copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.session import cut

MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else; ``lower`` does the same, faster, where every character is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """The normalised line: blanks at both ends stripped, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def key_hash(key: Column) -> Column:
    """128 bits of a key, so that different lines do not meet."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``docs`` with the columns ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    A line whose key has at least ``min_chars`` code points and occurs in at least
    ``min_docs`` documents stays only in the largest id that holds it. Lines are exploded
    as (document, position, hash); documents are counted per hash after a first grouping
    by hash and document, so a line that a third of all documents hold is summed on the
    map side. The verdicts come back as a list of positions per document.

    Null or empty text: one empty line, kept text ''. Null ids: one document of its own,
    smaller than all others. Rows that repeat an id: one document; each row keeps its own
    lines. Ties cannot occur, as the largest id is unique. Empty table: empty result.
    Columns other than the two named are passed on; the three added replace columns of
    the same name.
    """
    base = docs.drop("kept_text", "n_lines", "n_dropped")
    keyed = base.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"),
    )
    long_line = F.length(F.col("key")) >= min_chars
    lines = (
        keyed.select("id", "tag", F.posexplode(F.transform("lines", line_key)).alias("pos", "key"))
        .filter(long_line)
        .select("id", "tag", "pos", key_hash(F.col("key")).alias("h"))
    )
    per_doc = lines.groupBy("h", "id").agg(F.count(F.lit(1)).alias("n"))
    shared = (
        per_doc.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("home"))
        .filter(F.col("n_docs") >= min_docs)
        .select(F.col("h").alias("sh"), "home")
    )
    # Written, so that the join has plain shuffles on both sides and Spark can split a line that very many documents hold.
    shared = cut(shared)
    away = lines.join(shared, F.col("h") == F.col("sh")).filter(~F.col("id").eqNullSafe(F.col("home")))
    verdicts = away.groupBy(F.col("id").alias("__id"), F.col("tag").alias("__tag")).agg(F.collect_set("pos").alias("__gone"))
    marked = base.withColumn("__mark", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    on = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__tag"))
    whole = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    # The places that stay, by a set of those that go: a text of very many lines takes time in proportion.
    stay = lambda found: F.array_except(F.sequence(F.lit(0), F.size(found) - 1), F.col("__gone"))
    kept = let(whole, lambda found: F.transform(stay(found), lambda at: F.get(found, at)))
    untouched = F.col("__gone").isNull()
    return (
        marked.join(verdicts, on, "left")
        .withColumn("kept_text", F.when(untouched, F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(kept, "\n")))
        .withColumn("n_lines", F.size(whole).cast("bigint"))
        .withColumn("n_dropped", F.when(untouched, F.lit(0)).otherwise(F.size("__gone")).cast("bigint"))
        .drop("__id", "__tag", "__gone", "__mark")
    )
