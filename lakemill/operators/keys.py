"""Dense numbering, running ids and hash keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.bounds import order_columns
from lakemill.session import cut

_ROW_BITS = 33


def surrogate_key(df: DataFrame, name: str, order: list[str], start: int = 1) -> DataFrame:
    """Dense BIGINT numbers in the order given, which must be total (name tie-breaks).

    Rows are sorted by ranges, numbered inside each range, and shifted by the number of rows
    in earlier ranges. The sorted rows are written once to the shared folder, so that
    counting the ranges and numbering them see the same rows; no task sees all of them,
    whatever their number. Give slim rows where the others can be joined back.
    """
    ranged = df.repartitionByRange(*order_columns(order)).sortWithinPartitions(*order_columns(order))
    placed = cut(ranged.withColumn("__sk_place", F.monotonically_increasing_id()))
    part = F.shiftright("__sk_place", _ROW_BITS).alias("__sk_part")
    row = F.col("__sk_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__sk_rows"))
    before = Window.orderBy("__sk_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__sk_part", F.coalesce(F.sum("__sk_rows").over(before), F.lit(0)).alias("__sk_shift"))
    # One row per range, so the broadcast side is as small as the number of partitions.
    return (
        placed.withColumn("__sk_part", part)
        .join(F.broadcast(shifts), "__sk_part")
        .withColumn(name, F.col("__sk_shift") + row + F.lit(start))
        .drop("__sk_part", "__sk_place", "__sk_shift")
    )


def id_watermark(table: DataFrame | None, column: str) -> int:
    """Highest id in use, 0 for a missing or empty table."""
    if table is None:
        return 0
    return table.agg(F.coalesce(F.max(column), F.lit(0)).alias("top")).first()["top"]


def continue_ids(new: DataFrame, existing: DataFrame | None, name: str, order: list[str]) -> DataFrame:
    """Number new rows after the highest id already given out."""
    return surrogate_key(new, name, order, start=id_watermark(existing, name) + 1)


def hash_key(columns: list[str], null_as: dict[str, object] | None = None) -> Column:
    """64-bit key of a composite business key; NULL parts take the stand-in given.

    With n keys the odds of any collision are about n² / 2⁶⁵: check uniqueness.
    """
    null_as = null_as or {}
    parts = [F.coalesce(F.col(c), F.lit(null_as[c])) if c in null_as else F.col(c) for c in columns]
    return F.xxhash64(*parts)


def grow_dictionary(
    existing: DataFrame | None,
    members: DataFrame,
    key: str,
    id_name: str,
) -> DataFrame:
    """Members not yet known, numbered after the highest id; append the result."""
    fresh = members.dropDuplicates([key])
    if existing is not None:
        fresh = fresh.join(existing.select(key), key, "left_anti")
    return continue_ids(fresh, existing, id_name, [key])


def year_dimension(df: DataFrame, year: str, key: str = "timeKey") -> DataFrame:
    """One 1 January member per distinct year."""
    members = df.select(F.col(year).alias("year")).distinct()
    days = members.select("year", F.lit(1).alias("day"), F.lit(1).alias("month"))
    return surrogate_key(days, key, ["year"]).select(F.col(key).cast("int"), "day", "month", "year")


def remap_key(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Replace key values, e.g. ``{4: 2}``."""
    out = F.col(column)
    for old, new in mapping.items():
        out = F.when(F.col(column) == old, F.lit(new)).otherwise(out)
    return df.withColumn(column, out)
