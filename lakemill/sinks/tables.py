"""Tables in the session's catalog: create, replace, append, partition, compact.

A table is a folder of Parquet files plus a catalog entry. Replacing one writes a fresh
folder first and then points the entry at it; changing some partitions writes them beside the
old ones and swaps them in when the job commits. So a failed job leaves the old table as it
was, and a table may be changed by a query that reads it. One writer per table at a time.

Where the catalog's tables have row-level changes of their own, ``upsert`` and ``update`` hand
it a MERGE instead.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.operators import changes
from lakemill.operators.bounds import checked_broadcast, join_keys
from lakemill.session import cut

COMPRESSION = "gzip"
#: Table formats whose catalogs carry out MERGE.
ROW_LEVEL = {"iceberg", "delta", "hudi"}
#: Partitions named in one catalog statement.
SPECS = 1_000
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class Lake:
    """A database whose tables lie under one root folder."""

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        root: str,
        schemas: dict[str, tuple[T.StructType, list[str]]] | None = None,
        buckets: dict[str, tuple[int, list[str]]] | None = None,
    ):
        """``buckets`` gives, by table, how many buckets rows are dealt to and the key columns by which. Joins and changes on
        that key then read the table as it lies, whatever the size of the other side."""
        self.spark = spark
        self.database = database
        self.root = root
        self.schemas = schemas or {}
        self.buckets = buckets or {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def fit(self, table: str, df: DataFrame) -> DataFrame:
        """The registry's columns and types; absent ones are NULL, ``…_day`` columns are derived.

        A value that its column cannot hold becomes NULL; ``misfits`` counts such values.
        """
        schema, _ = self.schemas[table]
        df = self._with_days(table, df)
        return df.select(
            *[(F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema.fields]
        )

    def misfits(self, table: str, df: DataFrame) -> DataFrame:
        """Per column, how many values ``fit`` would turn into NULL."""
        schema, _ = self.schemas[table]
        shared = [f for f in schema.fields if f.name in df.columns]
        counts = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in shared]
        return df.agg(*counts).unpivot([], [f.name for f in shared], "column", "n_misfits")

    def _with_days(self, table: str, df: DataFrame) -> DataFrame:
        schema, _ = self.schemas.get(table, (T.StructType(), []))
        for name in schema.names:
            base = name.removesuffix("_day")
            if name not in df.columns and base != name and base in df.columns:
                df = with_day(df, base, name)
        return df

    def list_tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database))

    def describe(self, table: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE {self.name(table)}")

    def create(self, table: str, schema: T.StructType | None = None, partition_by: list[str] | None = None) -> None:
        """Create an empty table unless it exists; the registry gives what is left out."""
        if schema is None:
            schema, partition_by = self.schemas[table]
        by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        folder = self._fresh_folder(table)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet"
            f"{by}{self._clustered(table)} LOCATION '{folder}' TBLPROPERTIES ('compression' = '{COMPRESSION}')"
        )

    def _clustered(self, table: str) -> str:
        if table not in self.buckets:
            return ""
        n, keys = self.buckets[table]
        return f" CLUSTERED BY ({', '.join(f'`{k}`' for k in keys)}) INTO {n} BUCKETS"

    def create_all(self) -> None:
        for table in self.schemas:
            self.create(table)

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def replace(self, table: str, df: DataFrame, partition_by: list[str] | None = None, rows_per_file: int | None = None) -> DataFrame:
        """Write all rows to a fresh folder, then point the table at it.

        A table that keeps its columns stays in the catalog throughout. Only a change of
        columns or partitioning drops the entry and makes a new one.
        """
        if table in self.schemas:
            df, partition_by = self.fit(table, df), partition_by or self.schemas[table][1]
        by = partition_by or []
        folder = self._fresh_folder(table)
        fields = sorted(df.schema.fields, key=lambda f: by.index(f.name) if f.name in by else -1)
        shape = [(f.name, f.dataType.simpleString()) for f in fields]
        parts = f" PARTITIONED BY ({', '.join(by)})" if by else ""
        columns = ", ".join(f"`{n}` {kind}" for n, kind in shape)
        made = f"({columns}) USING parquet{parts}{self._clustered(table)} LOCATION '{folder}'"
        if table in self.buckets:
            # Spark writes buckets only through a table: one that is given up once its files are complete.
            draft = f"{table}_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {self.name(draft)} {made}")
            try:
                self._insert(draft, df, buckets=self.buckets[table])
            finally:
                self.drop(draft)
        else:
            write(df, folder, partition_by=by, rows_per_file=rows_per_file)
        if self.exists(table) and self.read(table).dtypes == shape and self.partitions(table) == by:
            for some in self._specs(table, by):
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {', '.join(some)}")
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{folder}'")
            if by:
                self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")
            self.spark.catalog.refreshTable(self.name(table))
            return self.read(table)
        self.drop(table)
        self.spark.sql(f"CREATE TABLE {self.name(table)} {made}")
        if by:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")
        return self.read(table)

    def append(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Add rows; the first call creates the table."""
        if table in self.schemas:
            df = self.fit(table, df)
        if not self.exists(table):
            return self.replace(table, df, partition_by)
        self._insert(table, df)
        return self.read(table)

    def upsert(self, table: str, source: DataFrame, keys: list[str], columns: list[str], inserts=None, order=None) -> DataFrame:
        """First load creates the table, later ones update and insert.

        The batch is written once to the shared folder, as several joins read it. Only
        partitions the batch can reach are rewritten.
        """
        batch = changes.dedup_by(source, keys, order) if order else source
        if not self.exists(table):
            return self.replace(table, batch.withColumns(inserts) if inserts else batch)
        once = cut(self._with_days(table, batch))
        if self.provider(table) in ROW_LEVEL:
            rows = once.withColumns(inserts) if inserts else once
            named = [c for c in self.read(table).columns if c in rows.columns]
            return self._merge(table, rows, keys, columns, {f"`{c}`": f"s.`{c}`" for c in named})
        return self.rewrite(table, once, keys, lambda t, b: changes.upsert(t, b, keys, columns, None, inserts))

    def update(self, table: str, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
        """Update matched rows only."""
        if self.provider(table) in ROW_LEVEL:
            return self._merge(table, source, keys, columns, None)
        return self.rewrite(table, cut(source), keys, lambda t, b: changes.merge_update(t, b, keys, columns))

    def replace_by_key(self, table: str, batch: DataFrame, keys: list[str], order: list[str], home: list[str] | None = None) -> DataFrame:
        """Drop rows whose key is in the batch, add the batch. ``home`` names partition
        columns that the key settles, so other partitions cannot hold it."""
        if not self.exists(table):
            return self.replace(table, changes.dedup_by(batch, keys, order))
        once = cut(changes.dedup_by(batch, keys, order))
        if table in self.schemas:
            once = self.fit(table, once)
        plain = table in self.buckets and self.buckets[table][1] == keys
        if plain:
            # A row without a key is no bucket's: it replaces nothing and is not replaced.
            return self.rewrite(table, once, [*keys, *(home or [])], lambda t, b: changes.replace_by_key(t, b, keys, keys, null_safe=False))
        return self.rewrite(table, once, [*keys, *(home or [])], lambda t, b: changes.replace_by_key(t, b, keys, keys))

    def provider(self, table: str) -> str:
        """Format of a table, as its catalog names it."""
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").filter("col_name = 'Provider'").first()
        return told["data_type"].lower() if told else ""

    def _merge(self, table: str, source: DataFrame, keys: list[str], columns: list[str], inserts: dict[str, str] | None) -> DataFrame:
        """Have the catalog carry out the change."""
        view = f"merge_{uuid.uuid4().hex}"
        source.createOrReplaceTempView(view)
        try:
            self.spark.sql(changes.merge_statement(self.name(table), view, keys, columns, inserts))
        finally:
            self.spark.catalog.dropTempView(view)
        return self.read(table)

    def read_between(self, table: str, column: str, since: str, before: str) -> DataFrame:
        """Rows with ``since`` <= column < ``before`` (timestamps as text), reading only the days of a derived ``…_day`` partition."""
        df, first, last = self.read(table), F.lit(since).cast("timestamp"), F.lit(before).cast("timestamp")
        day = f"{column}_day"
        inside = (F.col(column) >= first) & (F.col(column) < last)
        if day in self.partitions(table):
            inside = inside & (F.col(day) >= F.to_date(first)) & (F.col(day) <= F.to_date(last))
        return df.filter(inside)

    def partitions(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def rewrite(self, table: str, batch: DataFrame, keys: list[str], change) -> DataFrame:
        """Apply ``change(target, batch)``, rewriting only the partitions it can reach.

        Those are the partitions of the batch's rows, where the batch has them, and, unless
        the key settles the partition, of the target rows with the batch's keys; finding
        them reads just the key columns. The new partitions take the place of the old ones
        when the job commits, however many they are; a failed change leaves the table whole.
        """
        target, by = self.read(table), self.partitions(table)
        if not by:
            return self.replace(table, change(target, batch))
        placed = set(by) <= set(batch.columns)
        found = [batch.select(*by)] if placed else []
        settled = placed and set(by) <= set(keys)
        if not settled:
            found.append(join_keys(target.select(*dict.fromkeys([*keys, *by])), batch.select(*keys).distinct(), keys, "left_semi").select(*by))
        reached = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        touched = cut(reached.distinct())
        # Joined, not listed: Spark prunes the scan by the values that the join's small side turns out to hold.
        part = join_keys(target, checked_broadcast(touched), by, "left_semi")
        changed = change(part, batch).select(*target.columns)
        # Where rows can leave a partition, it may end up empty, and nothing would be written in its place.
        left = None if settled else cut(changed.select(*by).distinct())
        self._insert(table, changed, overwrite=True)
        if left is not None:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in target.schema.fields if f.name not in by)
            for some in self._specs(table, by, join_keys(touched, left, by, "left_anti")):
                for spec in some:
                    self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} {spec} SELECT {nothing} WHERE false")
        self.spark.catalog.refreshTable(self.name(table))
        return self.read(table)

    def _specs(self, table: str, by: list[str], of: DataFrame | None = None) -> Iterator[list[str]]:
        """PARTITION clauses of the catalog's partitions, or of the rows given, some at a time."""
        if not by:
            return
        if of is None:
            listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").toLocalIterator()
            values = ([part.split("=", 1)[1] for part in r["partition"].split("/")] for r in listed)
            values = ([None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for v in row] for row in values)
        else:
            values = ([r[c] for c in by] for r in of.toLocalIterator())
        text = lambda v: "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        specs = ("PARTITION (" + ", ".join(f"`{c}` = {text(v)}" for c, v in zip(by, row, strict=True)) + ")" for row in values)
        while some := list(islice(specs, SPECS)):
            yield some

    def _insert(self, table: str, df: DataFrame, overwrite: bool = False, buckets: tuple[int, list[str]] | None = None) -> None:
        """Add rows, or put them in place of all rows of their partitions."""
        by, conf, buckets = self.partitions(table), self.spark.conf, buckets or self.buckets.get(table)
        df = df.select(*self.read(table).columns)
        if buckets:
            # As the table deals them, so that a bucket is one file a partition.
            df = df.repartition(buckets[0], *buckets[1])
        elif by:
            df = df.hint("rebalance", *by)
        before = conf.get(_OVERWRITE_MODE)
        conf.set(_OVERWRITE_MODE, "dynamic")
        try:
            df.write.option("compression", COMPRESSION).insertInto(self.name(table), overwrite=overwrite)
        finally:
            conf.set(_OVERWRITE_MODE, before)

    def _fresh_folder(self, table: str) -> str:
        return os.path.join(self.root, table, uuid.uuid4().hex)


def write(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    rows_per_file: int | None = None,
) -> None:
    """Parquet with gzip. Rows of one partition are brought together before writing, and
    Spark splits a partition that is too large for one task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", COMPRESSION)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def with_day(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add the day of a timestamp, to partition by."""
    return df.withColumn(name or f"{column}_day", F.to_date(column))


def compact(df: DataFrame, n_rows: int, rows_per_file: int) -> DataFrame:
    """About ``n_rows / rows_per_file`` even files, at least one."""
    return df.repartition(max(1, math.ceil(n_rows / rows_per_file)))
