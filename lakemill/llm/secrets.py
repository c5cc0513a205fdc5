"""Secret scans with a ledger of blobs: a text is known by its content and scanned once per rule version."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.session import cut


class Rule(NamedTuple):
    """``pattern``'s matches count if group ``group`` has at least ``least`` characters.

    ``hints``: strings one of which every match contains, to pass over other texts quickly.
    Raise ``version`` whenever anything else here changes, so that old blobs are scanned again.
    """

    kind: str
    version: int
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base patterns, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", 1, r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII, 2, 8, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 0, 16, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
#: Kinds beyond the base, each with a version of its own.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, 1, ("-----BEGIN ",)),
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]+", 0, 0, 40, ("eyJ",)),
    Rule("forge", 1, r"gh[oprsu]_[A-Za-z0-9]+", 0, 0, 40, ("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
)
RULES = BASE_RULES + MORE_RULES
LEDGER = "blob string, done array<string>, found array<struct<kind:string,version:int,start:int,end:int>>"


def spans(text: str, rule: Rule, compiled: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap; those that are too short are dropped afterwards."""
    if rule.hints and not any(h in text for h in rule.hints):
        return []
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(r, re.compile(r.pattern, r.flags)) for r in rules]
        found_type = pa.list_(pa.struct([("kind", pa.string()), ("version", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        seen: set[str] = set()
        for batch in batches:
            # Rows that repeat a path and its text come to one task: their blob is scanned once.
            once = [i for i, b in enumerate(batch.column("blob").to_pylist()) if not (b in seen or seen.add(b))]
            batch, found = batch.take(pa.array(once, pa.int64())), []
            for text, todo in zip(batch.column("text"), batch.column("todo"), strict=True):
                own, names = text.as_py(), set(todo.as_py())
                found.append([(r.kind, r.version, a, b) for r, c in compiled if r.name in names for a, b in spans(own, r, c)])
            rows = [[dict(zip(("kind", "version", "start", "end"), f, strict=True)) for f in fs] for fs in found]
            yield pa.RecordBatch.from_arrays([batch.column("blob"), batch.column("todo"), pa.array(rows, found_type)], ["blob", "done", "found"])

    return run


def blob_of(text: Column) -> Column:
    """Content address: SHA-256 of the text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan_unseen(versions: DataFrame, path_col: str, text_col: str, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for what the ledger lacks: unseen blobs, and seen ones under unseen rule versions.

    Rows of ``versions`` are all historical versions of all paths. A blob is represented by
    the row with its least path, chosen from paths and hashes alone; texts are then dealt by
    (blob, path), so a blob that a third of all rows share is no hot key, and only the
    chosen rows reach the scan. Append the result to the ledger; findings are in ``found``,
    as code point spans, and ``done`` names the rule versions scanned.
    """
    own = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("blob", blob_of(F.col("text")))
    least = F.min(F.struct(F.col("path").isNull().alias("none"), F.col("path").alias("path")))
    blobs = own.groupBy("blob").agg(least["path"].alias("home"))
    every = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("todo", every)
    else:
        seen = ledger.groupBy(F.col("blob").alias("known")).agg(F.array_distinct(F.flatten(F.collect_list("done"))).alias("seen"))
        lacking = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        todo = blobs.join(seen, F.col("blob") == F.col("known"), "left").select("blob", "home", lacking.alias("todo")).filter(F.size("todo") > 0)
    todo = todo.withColumnRenamed("blob", "key")
    texts = own.join(todo, (F.col("blob") == F.col("key")) & F.col("path").eqNullSafe(F.col("home"))).select("blob", "text", "todo")
    return texts.mapInArrow(_scan(rules), LEDGER)


def findings(versions: DataFrame, ledger: DataFrame, path_col: str, text_col: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row's path, blob and ``found``: what the ledger says of its blob under the rules' versions.

    Found spans are sorted by start, then by the place of the kind in ``rules``. Blobs the
    ledger does not know have null. The join is by blob; Spark splits a hot one.
    """
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    current = F.array(*[F.lit(r.name) for r in rules])
    per_blob = ledger.groupBy(F.col("blob").alias("known")).agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("all"))
    ranked = F.transform(
        F.filter("all", lambda f: F.array_contains(current, F.concat(f["kind"], F.lit("@"), f["version"].cast("string")))),
        lambda f: F.struct(f["start"].alias("start"), F.array_position(kinds, f["kind"]).alias("place"), f["end"].alias("end"), f["kind"].alias("kind")),
    )
    # Written, so that the join has plain shuffles on both sides and Spark can split a hot blob.
    per_blob = cut(per_blob.select("known", F.array_sort(ranked).alias("found")))
    own = versions.select(F.col(path_col), blob_of(F.col(text_col)).alias("blob"))
    return own.join(per_blob, F.col("blob") == F.col("known"), "left").drop("known")


def scan(versions: DataFrame, path_col: str = "doc_id", text_col: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, blob and ``found`` of every row, scanning only what the ledger lacks.

    Null text: empty, no findings. Null paths and repeated rows: each row has its findings.
    Equal spans of different kinds (ties) are ordered by kind. Empty table: empty result.
    Other columns are ignored.
    """
    new = scan_unseen(versions, path_col, text_col, ledger, rules)
    return findings(versions, new if ledger is None else ledger.unionByName(new), path_col, text_col, rules)


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
