"""Entity spans from BIO tags, one row at a time, with array functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemill.functions.scalar import _col, let, words


def tag_types(tags: Column | str) -> Column:
    """Sorted distinct entity types in a tag string."""
    entity = F.filter(words(tags), lambda t: t.startswith("B-") | t.startswith("I-"))
    return F.array_sort(F.array_distinct(F.transform(entity, lambda t: F.substr(t, F.lit(3)))))


def aligned(tags: Column | str, text: Column | str) -> Column:
    """True where there are as many tags as tokens."""
    both = F.struct(words(tags).alias("a"), words(text).alias("b"))
    return let(both, lambda s: s["a"].isNotNull() & s["b"].isNotNull() & (F.size(s["a"]) == F.size(s["b"])))


def _type(tag: Column) -> Column:
    return F.substr(tag, F.lit(3))


def _spans(labels: Column, keep) -> Column:
    """(first, after, type) of maximal runs; a run goes on while ``I-`` keeps the type."""

    def body(tags: Column) -> Column:
        def goes_on(i: Column) -> Column:
            tag, before = F.get(tags, i), F.get(tags, i - 1)
            return (
                tag.startswith("I-")
                & (before.startswith("B-") | before.startswith("I-"))
                & (_type(tag) == _type(before))
            )

        count = F.size(tags)
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.expr("cast(array() as array<int>)"))
        starts = F.filter(places, lambda i: (i == 0) | ~F.coalesce(goes_on(i), F.lit(False)))
        runs = let(
            starts,
            lambda s: F.transform(
                s,
                lambda first, k: F.struct(
                    first.alias("first"),
                    F.coalesce(F.get(s, k + 1), count).alias("after"),
                    _type(F.get(tags, first)).alias("type"),
                ),
            ),
        )
        return F.filter(runs, lambda r: keep(F.get(tags, r["first"])) & (r["type"] != ""))

    return let(labels, body)


def bio_spans(tags: Column | str, text: Column | str) -> Column:
    """Array of (entityType, entityName) in text order.

    A span opens at ``B-`` and goes on over ``I-`` tags of its type. An ``I-`` tag of
    another type closes the span and its word is lost; an ``I-`` tag outside a span is
    ignored. Rows whose tag and token counts differ have no spans.
    """

    def body(s: Column) -> Column:
        found = _spans(s["tags"], lambda tag: tag.startswith("B-"))
        named = F.transform(
            found,
            lambda r: F.struct(
                r["type"].alias("entityType"),
                F.array_join(F.slice(s["tokens"], r["first"] + 1, r["after"] - r["first"]), " ").alias("entityName"),
            ),
        )
        return F.when(F.size(s["tags"]) == F.size(s["tokens"]), named)

    empty = F.expr("cast(array() as array<struct<entityType:string,entityName:string>>)")
    return F.coalesce(let(F.struct(words(tags).alias("tags"), words(text).alias("tokens")), body), empty)


def scoring_spans(tags: Column) -> Column:
    """Spans as ``type:first:after`` strings for evaluation; a stray ``I-`` opens a span."""
    found = _spans(tags, lambda tag: tag.startswith("B-") | tag.startswith("I-"))
    return F.transform(found, lambda r: F.concat_ws(":", r["type"], r["first"], r["after"]))


def clean_entity_name(c: Column | str) -> Column:
    """Underscores become spaces, dots at the ends and outer spaces go."""
    return F.trim(F.regexp_replace(F.replace(_col(c), F.lit("_"), F.lit(" ")), r"^\.+|\.+$", ""))


def clean_entities(tags: Column | str, text: Column | str) -> Column:
    """Spans with cleaned names, blank ones dropped, in (type, name) order."""
    cleaned = F.transform(
        bio_spans(tags, text),
        lambda e: F.struct(
            e["entityType"].alias("entityType"), clean_entity_name(e["entityName"]).alias("entityName")
        ),
    )
    return F.array_sort(F.filter(cleaned, lambda e: e["entityName"] != ""))
