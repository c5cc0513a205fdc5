"""Measures that compare rows of one group.

A window puts a whole group in one task. Where that could be too much, the group is
either aggregated first or ranked through a distributed sort. Groups are counted in
``counted``, if given: stored rows with the same groups, so that ``df`` is not worked out for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.aggregates import MONEY
from lakemill.operators.bounds import GROUP_ROWS, checked_broadcast, hot_groups, join_keys, order_columns, order_names
from lakemill.operators.keys import surrogate_key


def group_mean(
    df: DataFrame,
    by: list[str],
    value: str,
    name: str,
    digits: int = 2,
    group_rows: int = GROUP_ROWS,
    n_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Each row with its group's mean.

    A window, which shuffles the rows once. Groups too long for one task are aggregated
    instead; they are few, so their means are broadcast back.
    """
    window = Window.partitionBy(*by)
    exact = F.col(value).cast(MONEY)
    hot = hot_groups(df if counted is None else counted, by, group_rows, n_rows)
    if hot is None:
        return df.withColumn(name, F.round(F.avg(exact).over(window), digits).cast("double"))
    cold = join_keys(df, checked_broadcast(hot), by, "left_anti")
    cold = cold.withColumn(name, F.round(F.avg(exact).over(window), digits).cast("double"))
    large = join_keys(df, checked_broadcast(hot), by, "left_semi")
    means = large.groupBy(*by).agg(F.round(F.avg(exact), digits).cast("double").alias(name))
    return cold.unionByName(join_keys(large, checked_broadcast(means), by, "inner"))


def period_delta(
    df: DataFrame,
    by: list[str],
    period: str,
    value: str,
    name: str,
    digits: int = 2,
    ties: tuple[str, ...] = (),
    group_rows: int = GROUP_ROWS,
    n_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Change against the previous period that exists, 0 in the first.

    With one row per group and period a group is as long as there are periods. Where
    rows share a period (unresolved NULL keys can pile up), ``ties`` orders them, and a
    group too long for one task takes its predecessors from a distributed sort.
    """
    window = Window.partitionBy(*by).orderBy(period, *ties)
    before = "__before"
    hot = hot_groups(df if counted is None else counted, by, group_rows, n_rows)
    if hot is None:
        paired = df.withColumn(before, F.lag(value).over(window))
    else:
        cold = join_keys(df, checked_broadcast(hot), by, "left_anti").withColumn(before, F.lag(value).over(window))
        large = join_keys(df, checked_broadcast(hot), by, "left_semi")
        paired = cold.unionByName(_lag_by_sort(large, by, [period, *ties], value, before))
    change = F.col(value).cast(MONEY) - F.col(before).cast(MONEY)
    return paired.withColumn(name, F.coalesce(F.round(change, digits).cast("double"), F.lit(0.0))).drop(before)


def _lag_by_sort(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The value one place earlier in a distributed sort, if that row is of the same group."""
    placed = surrogate_key(df, "__place", [*by, *order])
    earlier = placed.select((F.col("__place") + 1).alias("__place"), *by, F.col(value).alias(name))
    return join_keys(placed, earlier, ["__place", *by], "left").drop("__place")


def rank_in_group(
    df: DataFrame,
    by: list[str],
    order: list[str],
    name: str,
    dense: bool = False,
    group_rows: int = GROUP_ROWS,
    n_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``row_number`` (or ``dense_rank``) inside each group.

    Groups with more than ``group_rows`` rows do not go through a window: they are sorted
    by ranges across the cluster and numbered relative to their first place.
    """
    window = Window.partitionBy(*by).orderBy(*order_columns(order))
    rank = F.dense_rank() if dense else F.row_number()
    hot = hot_groups(df if counted is None else counted, by, group_rows, n_rows)
    if hot is None:
        return df.withColumn(name, rank.over(window))
    cold = join_keys(df, checked_broadcast(hot), by, "left_anti").withColumn(name, rank.over(window))
    large = join_keys(df, checked_broadcast(hot), by, "left_semi")
    return cold.unionByName(_rank_by_sort(large, by, order, name, dense))


def _rank_by_sort(df: DataFrame, by: list[str], order: list[str], name: str, dense: bool) -> DataFrame:
    ordered = [*by, *order_names(order)]
    members = df.select(*ordered).distinct() if dense else df
    placed = surrogate_key(members, "__place", [*by, *order])
    firsts = placed.groupBy(*by).agg(F.min("__place").alias("__first"))
    ranked = join_keys(placed, checked_broadcast(firsts), by, "inner")
    ranked = ranked.withColumn(name, (F.col("__place") - F.col("__first") + 1).cast("int")).drop("__place", "__first")
    return join_keys(df, ranked, ordered, "inner") if dense else ranked


def first_in_group(df: DataFrame, by: list[str], order: list[str], n: int, name: str = "rn") -> DataFrame:
    """The first n rows of each group. Spark cuts groups to n rows before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order_columns(order))
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def top(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First n rows overall; each task keeps n."""
    return df.orderBy(*order_columns(order)).limit(n)


def top_groups(df: DataFrame, by: list[str], n: int, name: str = "n") -> DataFrame:
    """Largest groups by row count, ties by name."""
    return top(df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), [f"-{name}", *by], n)
