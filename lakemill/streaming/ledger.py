"""Load each source file exactly once.

Files are read once: their lines are staged in the shared folder, and headers and rows
come from there. ``load_new_files`` works in batches over a ledger table; ``stream_new_files``
leaves the bookkeeping to a Structured Streaming checkpoint. Both write each batch to its own
``ingest_run=…`` folder with overwrite, so a batch that is run again after a failure
replaces its own rows instead of adding them twice.
"""

from __future__ import annotations

import os
import uuid
from collections import defaultdict
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.session import cut
from lakemill.sources.csv_files import header_columns, headers, list_files, parse_lines, read_lines

LEDGER = "path string, run string, status string, at timestamp, reason string"
FILES_PER_BATCH = 5_000

PLANNED, LOADED, NO_KEY, UNREADABLE = "planned", "loaded", "no_key_column", "unreadable"
NO_HEADER = "no header line could be read"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Ledger rows; an unwritten ledger is empty."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def _log(spark: SparkSession, ledger: str, paths: list[str] | dict[str, str], run: str, status: str, run_ts: str) -> None:
    """Add a line per file; a dict gives each file's reason."""
    if not paths:
        return
    reasons = paths if isinstance(paths, dict) else {}
    data = [(p, run, status, reasons.get(p)) for p in paths]
    rows = spark.createDataFrame(data, "path string, run string, status string, reason string")
    dated = rows.select("path", "run", "status", F.lit(run_ts).cast("timestamp").alias("at"), "reason")
    dated.coalesce(1).write.mode("append").parquet(ledger)


def _open_runs(entries: DataFrame) -> dict[str, list[str]]:
    """Runs that were planned and not finished, with their files (at most a batch each)."""
    settled = entries.filter(F.col("status").isin(LOADED, UNREADABLE)).select("run", "path").distinct()
    rows = entries.filter(F.col("status") == PLANNED).join(settled, ["run", "path"], "left_anti").orderBy("run", "path").collect()
    runs = defaultdict(list)
    for r in rows:
        runs[r["run"]].append(r["path"])
    return dict(runs)


def new_files(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Files the ledger does not know."""
    return files.join(entries.select("path").distinct(), "path", "left_anti")


def load_new_files(
    spark: SparkSession,
    folder: str,
    target: str,
    ledger: str,
    transform: Callable[[DataFrame], DataFrame],
    key_column: str,
    run_ts: str,
    pattern: str = "*.csv",
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Load all files not yet in the ledger and return what was done per file.

    A file without ``key_column`` is logged and skipped. A file that cannot be read is
    logged as unreadable, with the reason, and the other files of its batch are loaded.
    Files are taken in batches in path order until none is left; only a batch's paths are
    held by the driver.
    """

    def finish(run: str, staged: Staged, paths: list[str]) -> None:
        _write(staged, paths, run, target, transform)
        _log(spark, ledger, paths, run, LOADED, run_ts)

    def refuse(run: str, staged: Staged) -> None:
        _log(spark, ledger, staged.bad, run, UNREADABLE, run_ts)

    for run, paths in _open_runs(read_ledger(spark, ledger)).items():
        staged = _stage(spark, paths)
        refuse(run, staged)
        finish(run, staged, list(staged.heads))
    # Listed once; files that come in meanwhile are for the next call.
    pending = cut(new_files(list_files(spark, folder, pattern), read_ledger(spark, ledger)).select("path"))
    last = ""
    while True:
        batch = pending.filter(F.col("path") > last).orderBy("path").limit(files_per_batch)
        paths = [r["path"] for r in batch.collect()]
        if not paths:
            break
        last, run = paths[-1], uuid.uuid4().hex
        staged = _stage(spark, paths)
        keyed = [p for p, head in staged.heads.items() if key_column in header_columns(head[1])]
        _log(spark, ledger, [p for p in staged.heads if p not in set(keyed)], run, NO_KEY, run_ts)
        refuse(run, staged)
        if keyed:
            _log(spark, ledger, keyed, run, PLANNED, run_ts)
            finish(run, staged, keyed)
    return read_ledger(spark, ledger).filter(F.col("status") != PLANNED)


def _plain(path: str) -> str:
    """``file:///a%20b``, as rows report their file, and ``file:/a b``, as listings do, are one."""
    return unquote(path).replace("file:///", "file:/")


class Staged(NamedTuple):
    """Lines of a batch, written once; per readable file, by the listing's path, the path its rows report, its header and
    that line's place; the files that cannot be read, with the reasons."""

    lines: DataFrame | None
    heads: dict[str, tuple[str, str, int]]
    bad: dict[str, str]


def _stage(spark: SparkSession, paths: list[str]) -> Staged:
    """Read files once. What one of them breaks is done again without it."""
    bad: dict[str, str] = {}
    try:
        lines = cut(read_lines(spark, paths))
    except Exception:
        bad = _unreadable(spark, paths)
        if not bad:
            raise
        good = [p for p in paths if p not in bad]
        lines = cut(read_lines(spark, good)) if good else None
    # One row for each file of the batch.
    found = {_plain(r["path"]): tuple(r) for r in headers(lines).collect()} if lines is not None else {}
    named = {p: found[p.replace("file:///", "file:/")] for p in paths if p.replace("file:///", "file:/") in found}
    return Staged(lines, named, bad | {p: NO_HEADER for p in paths if p not in named and p not in bad})


def _write(staged: Staged, paths: list[str], run: str, target: str, transform) -> None:
    """Write the rows of some files of a batch to the run's own folder."""
    if paths:
        heads = {staged.heads[p][0]: staged.heads[p][1:] for p in paths}
        transform(parse_lines(staged.lines, heads)).write.mode("overwrite").parquet(os.path.join(target, f"ingest_run={run}"))


def _unreadable(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Files whose lines cannot be read, found by halving: a few jobs for each bad file, not one for each file."""
    bad, open_groups = {}, [sorted(paths)]
    while open_groups:
        group = open_groups.pop()
        try:
            read_lines(spark, group).write.format("noop").mode("overwrite").save()
        except Exception as e:
            if len(group) == 1:
                bad[group[0]] = str(e).split("\n", 1)[0][:500]
            else:
                open_groups += [group[: len(group) // 2], group[len(group) // 2 :]]
    return bad


def stream_new_files(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    pattern: str = "*.csv",
    files_per_batch: int = 1_000,
) -> None:
    """Load all files that are new to ``checkpoint``, then stop.

    The stream is of file names; each batch is read by header, so files may have their
    columns in any order, and columns get the types of ``schema`` (NULL where a file lacks
    the column or a value does not fit). Files that cannot be read are left out and listed,
    with the reasons, in the folder ``<target>_unreadable``.
    """
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )

    def typed(rows: DataFrame) -> DataFrame:
        return transform(
            rows.select(
                *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in kinds.fields],
                "source_file",
            )
        )

    def put(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most files_per_batch names
        staged = _stage(spark, paths)
        _write(staged, list(staged.heads), str(number), target, typed)
        bad = staged.bad
        if bad:
            listed = spark.createDataFrame(list(bad.items()), "path string, reason string")
            listed.coalesce(1).write.mode("overwrite").parquet(os.path.join(f"{target}_unreadable", f"ingest_run={number}"))

    query = files.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
