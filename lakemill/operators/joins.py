"""Lookups, star resolution and the anti-joins behind incremental loads.

A dimension is counted before it is broadcast. One within the bound is never shuffled,
however few keys the fact rows pile up on; a larger one is left to Spark, which splits
skewed partitions of the fact side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.canonical import compose
from lakemill.functions.minitext import lookup_map, parse_entries, parse_map_by_id
from lakemill.operators.bounds import GROUP_ROWS, checked_broadcast, hot_groups, rows_within


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: Column | str, dim_key: Column | str, take: list[str]) -> DataFrame:
    """Left join on a cleaned expression key, keeping ``take`` from the dimension."""
    fact_key = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    dim_key = F.col(dim_key) if isinstance(dim_key, str) else dim_key
    slim = dim.select(dim_key.alias("__dim_key"), *take)
    return fact.withColumn("__key", fact_key).join(checked_broadcast(slim), F.col("__key") == F.col("__dim_key"), "left").drop(
        "__key", "__dim_key"
    )


def skew_lookup(fact: DataFrame, dim: DataFrame, key: str, take: list[str], hot_rows: int = GROUP_ROWS) -> DataFrame:
    """Left join to a large dimension with one row per key, safe against a key that holds
    many fact rows: those keys' dimension rows are few and are broadcast, the rest is
    shuffled."""
    slim = dim.select(key, *take)
    hot = hot_groups(fact, [key], hot_rows)
    if hot is None:
        return fact.join(slim, key, "left")
    few = checked_broadcast(hot.filter(F.col(key).isNotNull()))
    hot_side = fact.join(few, key, "left_semi").join(checked_broadcast(slim.join(few, key, "left_semi")), key, "left")
    cold_side = fact.filter(F.col(key).isNotNull()).join(few, key, "left_anti").join(slim, key, "left")
    kinds = {f.name: f.dataType for f in slim.schema.fields}
    no_key = fact.filter(F.col(key).isNull()).withColumns({c: F.lit(None).cast(kinds[c]) for c in take})
    return cold_side.unionByName(hot_side).unionByName(no_key)


#: Rows of a dictionary up to which it is one value that entries are looked up in.
LOOKUP_ROWS = 1_000


def maps_by_dictionary(df: DataFrame, column: str, dictionary: DataFrame, key: str, value: str, name: str, limit: int = LOOKUP_ROWS) -> DataFrame:
    """``df`` with a map made of a ``k:v`` list: keys are taken through a dictionary table, unknown ones dropped.

    A dictionary within the bound is one value of the query. With a larger one the entries of
    distinct texts are joined to it, and rows to what their text holds. Of equal keys the
    highest value counts; blank or NULL text gives an empty map.
    """
    if rows_within(dictionary, limit):
        known = df.withColumn("__ids", lookup_map(dictionary, key, value))
        return known.withColumn(name, parse_map_by_id(column, F.col("__ids"))).drop("__ids")
    unique = dictionary.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__known")).agg(F.max(value).alias("__id"))
    texts = df.select(F.col(column).alias("__text")).filter("__text is not null").distinct()
    entries = texts.select("__text", F.posexplode(parse_entries("__text")).alias("__at", "__e"))
    met = entries.join(unique, F.col("__e.key") == F.col("__known"))
    listed = F.array_sort(F.collect_list(F.struct("__at", "__id", F.col("__e.value").alias("v"))))
    made = F.map_from_entries(F.transform(listed, lambda x: F.struct(x["__id"], x["v"])))
    maps = met.groupBy("__text").agg(made.alias(name)).withColumnRenamed("__text", column)
    found = skew_lookup(df, maps, column, [name])
    kind = found.schema[name].dataType.simpleString()
    return found.withColumn(name, F.coalesce(name, F.expr(f"cast(map() as {kind})")))


@dataclass(frozen=True)
class Dim:
    """A dimension: rows, the fact column, the dimension's column, the keys to keep."""

    rows: DataFrame
    fact_column: str
    dim_column: str
    keep: tuple[str, ...]


def star_resolve(fact: DataFrame, dims: list[Dim]) -> DataFrame:
    """Fact rows with the surrogate keys of each dimension; a miss leaves NULL."""
    out = fact
    for i, d in enumerate(dims):
        on = f"__dim_{i}"
        slim = d.rows.select(F.col(d.dim_column).alias(on), *d.keep)
        out = out.join(checked_broadcast(slim), F.col(d.fact_column) == F.col(on), "left").drop(on)
    return out


def unresolved(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows found no dimension member, per key."""
    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    return counts.unpivot([], keys, "key", "n_unresolved")


def new_rows(df: DataFrame, known: DataFrame, key: str, known_key: str | None = None) -> DataFrame:
    """Rows whose key is not known yet."""
    keys = known.select(F.col(known_key or key).alias("__known"))
    return df.join(keys, F.col(key) == F.col("__known"), "left_anti")


def next_batch(df: DataFrame, known: DataFrame, key: str, size: int, known_key: str | None = None) -> DataFrame:
    """The next ``size`` unknown rows in key order; later calls take the rest."""
    return new_rows(df, known, key, known_key).orderBy(key).limit(size)


def dictionary_join(df: DataFrame, dictionary: DataFrame, column: str, take: list[str]) -> DataFrame:
    """Inner join to a small dictionary on ``lower(trim(…))`` of the composed text, without fan-out."""
    norm = F.lower(F.trim(compose(column)))
    slim = dictionary.select(norm.alias("__norm"), *take).distinct()
    return df.withColumn("__norm", norm).join(checked_broadcast(slim), "__norm", "inner").drop("__norm")


def repeated_keys(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row: joining on them would multiply fact rows."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def expect_unique(dim: DataFrame, keys: list[str]) -> DataFrame:
    """``dim`` itself; raises if a key repeats."""
    if not repeated_keys(dim, keys).isEmpty():
        raise ValueError(f"more than one row for some value of {keys}")
    return dim


def count_children(parents: DataFrame, children: DataFrame, key: str, group: list[str], name: str) -> DataFrame:
    """Children per parent, parents without any kept with 0.

    Children are counted before the join, so a parent with very many is one row by then.
    """
    counted = children.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    joined = parents.join(counted, key, "left")
    return joined.groupBy(*group).agg(F.sum(F.coalesce("__n", F.lit(0))).cast("bigint").alias(name))
