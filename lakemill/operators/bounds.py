"""Checks of size made before anything is broadcast or brought to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.session import cut

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
CONTROL_ROWS = 10_000
GROUP_ROWS = 5_000_000


def rows_within(df: DataFrame, limit: int) -> bool:
    """True if ``df`` has at most ``limit`` rows.

    Rows without columns are taken from a few partitions, then from more, until one too
    many is found, so a large stored table is not read through.
    """
    return df.select().offset(limit).isEmpty()


def bytes_within(df: DataFrame, limit: int) -> bool:
    """True if the values of ``df`` take at most ``limit`` bytes."""
    return _measured(df)["n_bytes"] <= limit


def _measured(df: DataFrame) -> Row:
    """Rows, and bytes of their values, in one job. Columns of fixed width are not read for that."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    wide = [f for f in df.schema.fields if not isinstance(f.dataType, fixed)]
    text = lambda f: F.col(f"`{f.name}`") if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(F.col(f"`{f.name}`")))
    sizes = [F.coalesce(F.octet_length(text(f)), F.lit(0)).cast("bigint") for f in wide]
    row = reduce(lambda a, b: a + b, sizes, F.lit(8 * (len(df.columns) - len(wide))).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row), F.lit(0)).alias("n_bytes")).first()


def input_bytes(df: DataFrame) -> int:
    """Bytes of all that ``df`` is made from, by Spark's own estimate: for a scan the bytes of its files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it is small, in rows and in bytes; else leave the join to Spark.

    What is made from little is measured in one job. Of anything else rows are counted
    first, up to the bound, so that a large table is not read through.
    """
    if input_bytes(df) > size and not rows_within(df, limit):
        return df
    found = _measured(df)
    return F.broadcast(df) if found["n_rows"] <= limit and found["n_bytes"] <= size else df


def control_rows(df: DataFrame, limit: int = CONTROL_ROWS) -> list[Row] | None:
    """Rows of a small control table, or None if it holds more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], right_keys: list[str] | None = None) -> Column:
    """Null-safe equality on all keys."""
    pairs = zip(keys, right_keys or keys, strict=True)
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    on = same_keys(left, renamed, keys, [f"__r_{k}" for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def order_columns(order: list[str]) -> list[Column]:
    """Sort columns; a leading ``-`` means descending."""
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def order_names(order: list[str]) -> list[str]:
    return [o.lstrip("-") for o in order]


def hot_groups(df: DataFrame, by: list[str], limit: int = GROUP_ROWS, n_rows: int | None = None) -> DataFrame | None:
    """Keys of groups with more than ``limit`` rows, or None if there are none.

    There can be no more than rows / limit of them, so the result is small. Where the
    number of all rows is known and within the limit, nothing is counted.
    """
    if n_rows is not None and n_rows <= limit:
        return None
    hot = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).drop("__n")
    held = cut(hot)
    return None if held.isEmpty() else held
