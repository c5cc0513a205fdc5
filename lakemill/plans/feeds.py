"""A table's changes as they were made, and counts that follow them.

A feed holds, for each run of a load, the rows it put into a table with sign 1 and the rows it
took out with sign -1. Anything that adds up over rows can be kept from it: each run is counted once,
and the counts of all runs add up to those of the table as it is.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.bounds import join_keys
from lakemill.session import cut
from lakemill.sinks.tables import Lake

SIGN = "__sign"
MARKS = "run string"


class Runs:
    """A folder with one sub-folder for each run, and marks of those that are complete."""

    def __init__(self, lake: Lake, *path: str):
        self.spark = lake.spark
        self.root = os.path.join(lake.root, *path)

    def complete(self) -> set[str]:
        """Runs whose rows are complete; there are few, one for each batch of files ever loaded."""
        try:
            return {r["run"] for r in self.spark.read.schema(MARKS).parquet(os.path.join(self.root, "marks")).collect()}
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return set()

    def folder(self, run: str) -> str:
        return os.path.join(self.root, f"ingest_run={run}")

    def put(self, run: str, rows: DataFrame) -> None:
        """Write a run's rows; doing it again before the mark is set replaces them."""
        rows.write.mode("overwrite").parquet(self.folder(run))
        self.spark.createDataFrame([(run,)], MARKS).coalesce(1).write.mode("append").parquet(os.path.join(self.root, "marks"))

    def read(self, runs: set[str]) -> DataFrame:
        return self.spark.read.parquet(*[self.folder(r) for r in sorted(runs)])


def feed(lake: Lake, table: str) -> Runs:
    return Runs(lake, "_changes", table)


def put_changes(lake: Lake, table: str, run: str, batch: DataFrame, keys: list[str], home: list[str]) -> DataFrame:
    """Note what replacing the batch's keys takes out of a table and puts in; returns the rows to put in.

    Call it before the table is changed. ``home`` are partition columns that the keys settle: only the
    batch's partitions are read. A run that is noted already is left as it is, since the table may
    have changed with it.
    """
    log = feed(lake, table)
    if run not in log.complete():
        once = cut(batch)
        changes = once.withColumn(SIGN, F.lit(1))
        if lake.exists(table):
            target, where = lake.read(table), [*keys, *home]
            old = join_keys(target, once.select(*where).distinct(), where, "left_semi").select(*once.columns)
            changes = changes.unionByName(old.withColumn(SIGN, F.lit(-1)))
        log.put(run, changes)
    return log.read({run}).filter(F.col(SIGN) == 1).drop(SIGN)


def follow(counts: Runs, log: Runs, count: Callable[[DataFrame], DataFrame], keys: list[str], quantity: str = "quantity") -> DataFrame:
    """``keys`` and their quantities after all runs of a feed. ``count`` is given only the changes not counted yet, a run at a time,
    and must weigh them by their sign."""
    done, noted = counts.complete(), log.complete()
    for run in sorted(noted - done):
        counts.put(run, count(log.read({run})))
    summed = counts.read(noted).groupBy(*keys).agg(F.sum(quantity).alias(quantity))
    return summed.filter(F.col(quantity) != 0)
