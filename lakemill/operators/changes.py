"""Row-level changes as set algebra: (target, source) → new target.

Plain tables have no MERGE, so each operation returns the table as it should be and the
writer swaps it in. Where a catalog does offer MERGE, ``merge_statement`` gives the text.

Most batches are small next to the table. The table is therefore the probe side of every
join: Spark broadcasts a small batch and does not shuffle the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.bounds import join_keys
from lakemill.operators.clean import dedup_by
from lakemill.session import cut

_SOURCE = "__s_"


def _marked(source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return source.select(*keys, *[F.col(c).alias(_SOURCE + c) for c in columns], F.lit(True).alias("__hit"))


def merge_update(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Matched rows take ``columns`` from the source, also where those are NULL; others stay.

    The source must hold one row per key. NULL key parts match NULL.
    """
    joined = join_keys(target, _marked(source, keys, columns), keys, "left")
    out = [
        F.when(F.col("__hit"), F.col(_SOURCE + c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns
    ]
    return joined.select(*out)


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Source rows whose key the target lacks; append the result.

    The keys in common are found first by filtering the target with the source, so a
    small source is never joined against the whole table in a shuffle. With
    ``null_safe=False`` a NULL key matches nothing and is always new.
    """
    if null_safe:
        common = join_keys(target.select(*keys), source.select(*keys).distinct(), keys, "left_semi").distinct()
        return join_keys(source, common, keys, "left_anti")
    common = target.select(*keys).join(source.select(*keys).distinct(), keys, "left_semi").distinct()
    return source.join(common, keys, "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    columns: list[str],
    order: list[str] | None = None,
    inserts: dict[str, Column] | None = None,
) -> DataFrame:
    """Update matched rows, add the others.

    ``order`` picks the survivor among source rows of one key; the survivors are written
    to the shared folder, as three joins read them. ``inserts`` gives the
    columns a new row gets beyond those the source has, such as a hash id; remaining
    target columns are NULL.
    """
    batch = cut(dedup_by(source, keys, order)) if order else source
    updated = merge_update(target, batch, keys, columns)
    fresh = insert_absent(target, batch, keys)
    if inserts:
        fresh = fresh.withColumns(inserts)
    kinds = {f.name: f.dataType for f in target.schema.fields}
    fresh = fresh.select(
        *[(F.col(c) if c in fresh.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in target.columns]
    )
    return updated.unionByName(fresh)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str], null_safe: bool = True) -> DataFrame:
    """Drop the target's rows whose key is in the batch, then add the batch, one row per key.

    With ``null_safe=False`` a NULL key matches nothing; only then can a target that is
    bucketed by its key be joined as it lies.
    """
    known = batch.select(*keys).distinct()
    kept = join_keys(target, known, keys, "left_anti") if null_safe else target.join(known, keys, "left_anti").select(*target.columns)
    return kept.unionByName(dedup_by(batch, keys, order))


def reset_column(target: DataFrame, column: str, stamp: Column, scope: Column | None = None, stamp_column: str = "updated_at") -> DataFrame:
    """Set a derived column to NULL and refresh the stamp, for all rows or those in ``scope``."""
    inside = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
    kind = target.schema[column].dataType
    return target.withColumns(
        {
            column: F.when(~inside, F.col(column)).otherwise(F.lit(None).cast(kind)),
            stamp_column: F.when(inside, stamp).otherwise(F.col(stamp_column)),
        }
    )


def reset_by_type(target: DataFrame, types: DataFrame, key: str, type_column: str, wanted: str, column: str, stamp: Column) -> DataFrame:
    """``reset_column`` for rows whose key belongs to one type of a dictionary."""
    chosen = types.filter(F.col(type_column) == wanted).select(F.col(key).alias("__k"), F.lit(True).alias("__in")).distinct()
    joined = target.join(chosen, F.col(key) == F.col("__k"), "left")
    return reset_column(joined, column, stamp, F.col("__in")).select(*target.columns)


def merge_statement(table: str, view: str, keys: list[str], columns: list[str], inserts: dict[str, str] | None = None) -> str:
    """MERGE text for a catalog with row-level changes; without ``inserts`` it only updates."""
    on = " AND ".join(f"t.{k} <=> s.{k}" for k in keys)
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns)
    text = f"MERGE INTO {table} t USING {view} s ON {on} WHEN MATCHED THEN UPDATE SET {sets}"
    if inserts:
        names, values = ", ".join(inserts), ", ".join(inserts.values())
        text += f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    return text
