"""Projection, filters and removal of copies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.canonical import compose
from lakemill.operators.bounds import order_columns


def project_cast(df: DataFrame, spec: dict[str, tuple[str | Column, str]]) -> DataFrame:
    """``{new name: (source, type)}``; string input that does not fit the type becomes NULL."""
    out = []
    for name, (source, kind) in spec.items():
        c = F.col(source) if isinstance(source, str) else source
        out.append(c.try_cast(kind).alias(name))
    return df.select(*out)


def by_position(df: DataFrame, spec: dict[int, tuple[str, str]]) -> DataFrame:
    """Pick columns by place, for files whose headers vary: ``{0: ("id", "int")}``."""
    return df.select(*[F.col(f"`{df.columns[i]}`").try_cast(kind).alias(name) for i, (name, kind) in spec.items()])


def column_or(df: DataFrame, name: str, default, kind: str = "string") -> Column:
    """The column if the source has it, else a typed literal."""
    return F.col(name) if name in df.columns else F.lit(default).cast(kind)


def align(df: DataFrame, spec: dict[str, tuple[str, object]]) -> DataFrame:
    """Bring a poorer source to ``{column: (type, default)}``, missing columns filled with the default."""
    return df.select(*[column_or(df, n, d, k).cast(k).alias(n) for n, (k, d) in spec.items()])


def with_audit(df: DataFrame, run_ts: str | Column) -> DataFrame:
    """``created_at`` and ``updated_at`` set to the run's time, given by the caller."""
    stamp = F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts
    return df.withColumns({"created_at": stamp, "updated_at": stamp})


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def non_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.trim(F.col(c)) != "" for c in columns]))


def drop_sentinels(df: DataFrame, column: str, sentinels=("nan", "none")) -> DataFrame:
    """Drop rows whose value is a textual null, compared without case."""
    return df.filter(~F.lower(F.col(column)).isin(*sentinels))


def dedup_all(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_by(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark cuts each group to its first row before the shuffle, so a key that holds
    many rows sends few of them.
    """
    window = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def dedup_ignore_case(df: DataFrame, column: str) -> DataFrame:
    """Distinct values compared without case, and with letters composed; the smallest spelling stays."""
    return df.groupBy(F.lower(compose(column)).alias("__key")).agg(F.min(column).alias(column)).drop("__key")
