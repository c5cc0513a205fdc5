"""Grouped measures. All are plain aggregates, so Spark combines before it shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.minitext import split_trim
from lakemill.functions.scalar import floor_bin, let
from lakemill.operators.bounds import checked_broadcast, rows_within
from lakemill.session import cut

MONEY = "decimal(18,2)"
SCORE = "decimal(18,4)"


def group_count(df: DataFrame, by: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def group_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows, mean, least and greatest value per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(value).cast(MONEY)).cast("double").alias("mean"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def mean_of_distinct(df: DataFrame, by: list[str], value: str, name: str, digits: int = 2) -> DataFrame:
    """Mean of the distinct values per business key, rounded.

    Copies are removed first, so a key with many equal rows is small in the second step.
    """
    distinct = df.select(*by, F.col(value).cast(MONEY).alias("__v")).distinct()
    return distinct.groupBy(*by).agg(F.round(F.avg("__v"), digits).cast("double").alias(name))


def count_and_distinct(df: DataFrame, by: list[str], column: str, rows: str, distinct: str) -> DataFrame:
    """Rows and distinct non-null values per group.

    Grouped by value first: a hot group is spread over its values.
    """
    per_value = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n"))
    return per_value.groupBy(*by).agg(
        F.sum("__n").cast("bigint").alias(rows), F.count(column).alias(distinct)
    )


def null_counts(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Total, NULL and non-NULL rows per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(column).isNull()).alias("null_count"),
        F.count(column).alias("not_null_count"),
    )


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Total, mapped, unmapped and the mapped share in percent; no rows give a NULL share."""
    total, mapped = F.count(F.lit(1)), F.count(column)
    return df.agg(
        total.alias("total"),
        mapped.alias("mapped"),
        (total - mapped).alias("unmapped"),
        F.round(mapped * 100 / F.nullif(total, F.lit(0)), 4).alias("pct_mapped"),
    )


def map_size_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.size(column).alias("n_entries")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, value: str, width: str, by: list[str], bin_name: str, count_name: str, weight: str | None = None) -> DataFrame:
    """Rows (or the sum of ``weight``) per group and bin of the width given (a decimal written as text)."""
    binned = df.select(*by, floor_bin(value, width).alias(bin_name), *([weight] if weight else []))
    counted = F.sum(weight).cast("bigint") if weight else F.count(F.lit(1))
    return binned.groupBy(*by, bin_name).agg(counted.alias(count_name))


def group_members(groups: DataFrame, group: str, combination: str) -> DataFrame:
    """(group, member, n_members) from a ``-`` list such as ``Toán-Lý-Hoá``."""
    listed = groups.select(group, F.array_distinct(split_trim(combination, "-")).alias("__m"))
    return listed.select(group, F.explode("__m").alias("member"), F.size("__m").alias("n_members"))


def complete_sum(facts: DataFrame, by: list[str], member: str, value: str, members: DataFrame, group: str, name: str) -> DataFrame:
    """Per entity and group, the sum of its members' values, only where all members are present.

    ``members`` holds (group, member, n_members). Facts are summed per entity and member
    before the join.
    """
    summed = facts.groupBy(*by, member).agg(F.sum(F.col(value).cast(SCORE)).alias("__v"))
    joined = summed.join(checked_broadcast(members.withColumnRenamed("member", member)), member, "inner")
    totals = joined.groupBy(*by, group).agg(
        F.sum("__v").alias("__sum"), F.count("__v").alias("__have"), F.max("n_members").alias("__need")
    )
    return totals.filter("__have = __need").select(*by, group, F.col("__sum").cast("double").alias(name))


#: Ten-thousandths; values below the bound, in sums of at most so many, stay whole numbers below 2⁵³ of them.
SCORE_UNITS, PLAIN_SCORE, PLAIN_MEMBERS = 10_000.0, 1e5, 1_000_000
#: First members up to which the index of groups is looked up inside the row.
INDEX_MEMBERS = 200


def group_index(members: DataFrame, group: str) -> DataFrame:
    """(first, groups) — an inverted index: each group, with its members, under the one that fewest groups have."""
    share = members.groupBy("member").agg(F.count(F.lit(1)).alias("__share"))
    listed = members.join(share, "member").groupBy(group).agg(F.array_sort(F.collect_list(F.struct("__share", "member"))).alias("__by_share"))
    entry = F.struct(F.col(group).alias("group"), F.transform("__by_share", lambda x: x["member"]).alias("members"))
    return listed.groupBy(F.col("__by_share")[0]["member"].alias("first")).agg(F.collect_list(entry).alias("groups"))


def complete_sum_of_maps(df: DataFrame, keep: list[str], scores: str, members: DataFrame, group: str, name: str, index_members: int = INDEX_MEMBERS) -> DataFrame:
    """As ``complete_sum`` for rows that hold their values in a map; equal rows each get a result.

    Groups are found through an inverted index on their rarest members, by the map's keys
    alone. An index with few entries is looked up in the row. With a larger one the
    distinct sets of keys are joined to it, which are far fewer than the rows, and the
    rows to what their set holds. Either way sums are made in the row, before the groups
    found are exploded, so no map is copied. A member whose value is NULL is missing.

    Sums are those of decimals with four places. Values that have no more places and are
    not large are summed as whole ten-thousandths, which a double holds exactly: the sum's
    quotient is then the double nearest to the decimal sum, as is the decimal's cast.
    """
    index = group_index(members, group)
    keys = F.map_keys(F.map_filter(scores, lambda _k, v: v.isNotNull()))
    has_all = lambda held, g: F.forall(g["members"], lambda k: F.array_contains(held, k))
    if rows_within(index, index_members):
        entries = index.agg(F.collect_list(F.struct("first", "groups"))).scalar()
        found = let(
            F.struct(F.col("__keys").alias("k"), F.col("__index").alias("e")),
            lambda s: F.filter(
                F.flatten(F.transform(F.filter(s["e"], lambda e: F.array_contains(s["k"], e["first"])), lambda e: e["groups"])),
                lambda g: has_all(s["k"], g),
            ),
        )
        looked = df.select(*keep, F.col(scores).alias("__map"), keys.alias("__keys"), entries.alias("__index"))
        met = looked.select(*keep, "__map", found.alias("__found"))
    else:
        keyed = df.select(*keep, F.col(scores).alias("__map"), F.array_sort(keys).alias("__keys"))
        sets = keyed.select("__keys").distinct().select("__keys", F.explode("__keys").alias("__key"))
        held = sets.join(index, F.col("__key") == F.col("first")).select("__keys", F.explode("groups").alias("__g")).filter(has_all(F.col("__keys"), F.col("__g")))
        # Written once: it is measured, then joined.
        complete = cut(held.groupBy("__keys").agg(F.collect_list("__g").alias("__found")))
        met = keyed.join(checked_broadcast(complete), "__keys")
    zero = F.lit(0).cast("decimal(28,4)")
    units = lambda v: F.rint(v * SCORE_UNITS)

    def total(s: Column, g: Column) -> Column:
        add = lambda acc, k: (acc + F.try_element_at(s["m"], k).cast(SCORE)).cast("decimal(28,4)")
        count = lambda acc, k: acc + units(F.try_element_at(s["m"], k))
        exact = F.aggregate(g["members"], zero, add).cast("double")
        whole = F.aggregate(g["members"], F.lit(0.0), count) / SCORE_UNITS
        few = s["plain"] & (F.size(g["members"]) <= PLAIN_MEMBERS)
        return F.struct(g["group"].alias("group"), F.when(few, whole).otherwise(exact).alias("total"))

    plain = F.forall(F.map_values("__map"), lambda v: v.isNull() | ((F.abs(v) < PLAIN_SCORE) & (units(v) / SCORE_UNITS == v)))
    held = F.struct(F.col("__map").alias("m"), F.col("__found").alias("f"), plain.alias("plain"))
    sums = let(held, lambda s: F.transform(s["f"], lambda g: total(s, g)))
    each = met.select(*keep, F.explode(sums).alias("__sum"))
    return each.select(*keep, F.col("__sum.group").alias(group), F.col("__sum.total").alias(name))


def vocabulary(df: DataFrame, labels: str, name: str = "label") -> DataFrame:
    """Distinct labels of an array column; number them with ``surrogate_key(…, start=0)``."""
    return df.select(F.explode(labels).alias(name)).distinct()


def counts_by_label(df: DataFrame, by: list[Column | str], label: str, values: list[str]) -> DataFrame:
    """One count column per label value, plus the total."""
    return df.groupBy(*by).agg(
        *[F.count_if(F.col(label) == v).alias(v) for v in values], F.count(F.lit(1)).alias("total")
    )
