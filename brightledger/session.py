"""Session set-up and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which the shuffle files of a query go as soon as the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "brightledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for stage tables: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is used only for a local master with the setting unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="brightledger-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files: its result is on disk, and nothing reads them again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, label: str, partition_by: str | None = None, onto: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a Parquet stage table, or add it to the stage table ``onto``, and read it back.

    The result has no lineage before the written files, so a lost executor never causes
    an iterative plan to be replayed, and later stages prune columns of the table.
    """
    path = scratch_path(df.sparkSession, label) if onto is None else onto._stage
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, mode=None if onto is None else "append", partitionBy=partition_by)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if partition_by is not None:
        out = out.select(*df.columns)  # the reader puts that column last
    out._stage = path
    return out


def drop_stage(df: DataFrame | None) -> None:
    """Delete the files of a table that ``materialise`` returned, when nothing reads it any more; other tables stay as they are."""
    path = getattr(df, "_stage", None)
    if path is not None:
        jvm = df.sparkSession.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
