"""Small delimited formats kept in strings: ``k:v`` lists, ``|`` labels, ``-`` lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalar import NUMBER, SPACE, _col, let, strip_space

# A pair with a second colon, and all that follows it.
BROKEN_PAIR = r"(?s)(?:^|,)[^,:]*:[^,:]*:.*$"
# Any white space but blanks, and other characters between U+1680 and U+3000: a set and one range, which is quick to look for.
OTHER_SPACE = "[" + "".join(x for x in SPACE if x != " " and x < "\u0100") + "\u1680-\u3000]"


def split_trim(c: Column | str, separator: str) -> Column:
    """Split on a regex, trim each part, drop blank parts."""
    parts = F.transform(F.split(_col(c), separator), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def split_labels(c: Column | str) -> Column:
    """Distinct labels of an ``A|B`` string; ``None`` and blanks are no labels."""
    parts = F.filter(F.split(_col(c), r"\|"), lambda p: (p != "None") & (F.trim(p) != ""))
    return F.array_distinct(F.transform(parts, lambda p: F.trim(p)))


def parse_entries(c: Column | str) -> Column:
    """``"Toán:2.2,Văn:x,Sử:5"`` as an array of (key, value), one per key.

    Pairs without a colon and values that are no numbers are dropped, reading stops at
    a pair with a second colon, and the last of several equal keys wins.
    """
    readable = F.regexp_replace(_col(c), BROKEN_PAIR, "")

    pairs = F.filter(F.split(readable, ","), lambda x: x.contains(":"))

    def stripped(strip) -> Column:
        return F.transform(
            pairs,
            lambda x: F.struct(
                strip(F.substring_index(x, ":", 1)).alias("key"),
                strip(F.substring_index(x, ":", -1)).alias("text"),
            ),
        )

    # Stripping all white space is slow, so only texts that have any beside blanks go that way.
    sides = F.when(_col(c).rlike(OTHER_SPACE), stripped(strip_space)).otherwise(stripped(F.trim))
    # Tested first: a cast that fails is slow.
    entries = F.transform(
        F.filter(sides, lambda e: e["text"].rlike(NUMBER)),
        lambda e: F.struct(e["key"].alias("key"), e["text"].try_cast("double").alias("value")),
    )

    def last_wins(s: Column) -> Column:
        es, keys = s["es"], s["keys"]
        unique = F.filter(es, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), es).otherwise(unique)

    kept = let(
        let(entries, lambda es: F.struct(es.alias("es"), F.transform(es, lambda e: e["key"]).alias("keys"))), last_wins
    )
    return F.coalesce(kept, F.expr("cast(array() as array<struct<key:string,value:double>>)"))


def parse_map(c: Column | str) -> Column:
    """``k:v`` list as MAP<STRING, DOUBLE>; blank or NULL text gives an empty map."""
    return F.map_from_entries(parse_entries(c))


def parse_map_by_id(c: Column | str, ids: Column | dict[str, int]) -> Column:
    """``k:v`` list as MAP<INT, DOUBLE>, keys taken through a map of ids, unknown keys dropped.

    ``ids`` may be a column, such as ``lookup_map(…)`` of a dictionary table.
    """
    if isinstance(ids, dict):
        pairs = [F.lit(x) for pair in ids.items() for x in pair]
        ids = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,int>)")
    table = ids
    known = F.filter(parse_entries(c), lambda e: F.map_contains_key(table, e["key"]))
    return F.map_from_entries(
        F.transform(known, lambda e: F.struct(F.try_element_at(table, e["key"]).alias("key"), e["value"].alias("value")))
    )


def lookup_map(dictionary: DataFrame, key: str, value: str) -> Column:
    """A dictionary table as one MAP value of the query (a scalar subquery); of equal keys the highest value."""
    unique = dictionary.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias("__v"))
    return unique.agg(F.map_from_entries(F.collect_list(F.struct(key, "__v")))).scalar()


def sorted_values(df: DataFrame, column: str) -> Column:
    """Distinct values of a column, sorted, as one ARRAY value of the query (a scalar subquery)."""
    return df.agg(F.sort_array(F.collect_set(column))).scalar()


def multi_hot(labels: Column | str, vocabulary: Column) -> Column:
    """0/1 vector over a sorted vocabulary array."""
    labels = _col(labels)
    return let(
        F.struct(labels.alias("l"), vocabulary.alias("v")),
        lambda s: F.transform(s["v"], lambda x: F.array_contains(s["l"], x).cast("int")),
    )


def labels_above(probabilities: Column | str, names: list[str], threshold: float = 0.5, none: str = "None") -> Column:
    """Names whose probability exceeds the threshold joined by ``|``; none → ``None``.

    NULL where there are not as many probabilities as names.
    """
    table = F.array(*[F.lit(n) for n in names])
    chosen = F.filter(table, lambda _n, i: F.get(_col(probabilities), i) > threshold)
    text = F.array_join(chosen, "|")
    return F.when(F.size(_col(probabilities)) == len(names), F.when(text == "", F.lit(none)).otherwise(text))


def best_label(scores: Column | str, names: list[str]) -> Column:
    """Name of the first highest score."""
    scores = _col(scores)
    table = F.array(*[F.lit(n) for n in names])
    place = let(scores, lambda s: F.array_position(s, F.array_max(s)))
    return F.get(table, place.cast("int") - 1)


def sigmoid(logits: Column | str) -> Column:
    return F.transform(_col(logits), lambda x: 1 / (1 + F.exp(-x)))
