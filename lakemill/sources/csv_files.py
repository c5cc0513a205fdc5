"""CSV readers and file listings. Paths may be local or on any store Spark knows."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.functions.scalar import path_year


def read_csv(spark: SparkSession, paths: str | list[str], infer: bool = False, schema: T.StructType | str | None = None) -> DataFrame:
    """UTF-8 CSV with a header. All columns are strings unless a schema is given or inferred.

    Columns go by name: files whose header names other columns, or the same in another
    order, make the read fail instead of mixing columns up (``parse_lines`` reads such
    files). Inference reads the files once more; give a schema where they are large.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("enforceSchema", False)
    if schema is not None:
        return reader.schema(schema).csv(paths)
    return reader.option("inferSchema", infer).csv(paths)


def read_exact(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only the rows that have exactly as many fields as there are columns."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("columnPruning", False)
    return reader.option("escape", '"').schema(schema).csv(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, length, modified) of the files, without opening them."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return reader.load(folder).select("path", "length", F.col("modificationTime").alias("modified"))


def with_file(df: DataFrame, name: str = "path") -> DataFrame:
    """Add the path of the file a row came from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def with_path_year(df: DataFrame, name: str = "year", path: str = "path") -> DataFrame:
    """Add the year folder of the row's file."""
    return with_file(df, path).withColumn(name, path_year(path))


def read_tagged(
    spark: SparkSession, sources: dict[object, str | list[str]], tag: str, infer: bool = False, skipped: dict[object, str] | None = None
) -> DataFrame:
    """Read several sources, mark each row with its source's tag, union by name.

    A source that cannot be read is left out with a warning, and its reason is put into
    ``skipped``; if none can, the last error is raised.
    """
    parts, error = [], None
    for value, paths in sources.items():
        try:
            parts.append(read_csv(spark, paths, infer=infer).withColumn(tag, F.lit(value)))
        except Exception as e:
            error = e
            warnings.warn(f"source {value!r} cannot be read and is left out: {str(e)[:200]}", stacklevel=2)
            if skipped is not None:
                skipped[value] = str(e)
    if not parts:
        raise error or ValueError("no sources")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, begins, line, value) of every line that is not blank, from one scan of the files.

    ``line`` orders the lines of a block; ``begins`` marks those of a file's first block.
    Write the result before use: header lines and rows then come from one reading.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start") == 0).alias("begins"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return lines.filter(F.col("value").rlike(r"[^\x00-\x20]"))


def headers(lines: DataFrame) -> DataFrame:
    """(path, header, line) of each file: its first line, without a byte order mark."""
    heads = lines.filter("begins").groupBy("path").agg(F.min_by("value", "line").alias("header"), F.min("line").alias("line"))
    return heads.withColumn("header", F.regexp_replace("header", "^\ufeff", ""))


def header_columns(header: str) -> list[str]:
    return [c.strip().strip('"') for c in header.rstrip("\r\n").split(",")]


def parse_lines(lines: DataFrame, heads: dict[str, tuple[str, int]]) -> DataFrame:
    """Rows of the files of ``heads`` (path to header and its line): strings by column name, NULL where a file lacks a column.

    Lines are parsed once, by place, and columns are picked by each file's layout, so files
    whose headers differ share one pass. Of equal names in a header the first counts.
    """
    layouts = {header: i for i, header in enumerate(dict.fromkeys(h for h, _ in heads.values()))}
    known = [(path, line, layouts[header]) for path, (header, line) in heads.items()]
    # A row for each file of the batch, as the caller holds them already.
    table = F.broadcast(lines.sparkSession.createDataFrame(known, "path string, head bigint, layout int"))
    columns = [header_columns(h) for h in layouts]
    fields = ", ".join(f"f{i} string" for i in range(max(map(len, columns))))
    body = lines.join(table, "path").filter(F.col("line") != F.col("head"))
    parsed = body.select("path", "layout", F.from_csv("value", fields).alias("row"))

    def column(name: str) -> Column:
        held = [F.when(F.col("layout") == i, F.col(f"row.f{c.index(name)}")) for i, c in enumerate(columns) if name in c]
        return F.coalesce(*held).alias(name)

    return parsed.select(*[column(n) for n in dict.fromkeys(n for c in columns for n in c)], F.col("path").alias("source_file"))
