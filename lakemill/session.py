"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def build_session(app: str = "lakemill", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with adaptive execution and UTC; object-store or catalog settings go in ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def s3a_conf(endpoint: str, access_key: str, secret_key: str, path_style: bool = True, tls: bool = False) -> dict[str, str]:
    """Settings for an S3-like store, to pass to ``build_session``. Keys come from the caller."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A private folder is made only where none is named and the master is local.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = context.getCheckpointDir()
    if configured:
        if active is None:
            context.setCheckpointDir(configured)
        return configured
    if active:
        return active
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="lakemill-")
    context.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path inside the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    Used where a result is read several times and the readings must agree, also
    after an executor is lost.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet in the shared folder and read from there, and the folder, for ``discard``.

    Like ``cut`` where rows are many and alike: values in columns take a fraction of the room that rows do.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder written by ``stored`` that nothing will read any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let go of what earlier steps shuffled, in a long job whose steps are cut from each other.

    Spark removes shuffle files once the driver no longer refers to their plans, and finds
    that out when the driver's memory is collected, which it is asked for here.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have whole texts go to Python in batches of at most ``BATCH_BYTES``, unless the session says how large they may be.

    Batches are bounded in rows by default, and ten thousand texts can be many megabytes, which are held on both sides.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


SPREAD_BYTES = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal rows of a small input out evenly, for work that is heavy per row.

    Only where the scan, by Spark's own estimate, has less than ``SPREAD_BYTES`` for each
    core: such an input can be one file with one row group, which no split size divides.
    Anything larger is left to the scan's splits and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SPREAD_BYTES else df
