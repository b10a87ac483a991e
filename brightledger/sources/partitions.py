"""Stored tables changed in place: only partitions that hold changed rows are written again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.operators.rows import keyed_update
from brightledger.session import materialise


def overwrite_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Replace the partitions that ``rows`` has rows of; all others keep their files.

    New files take the place of the old ones when the whole job has ended, so a run that fails leaves the table as it was.
    """
    writer = rows.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by).parquet(path)


def update_in_place(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], by: str) -> int:
    """Set ``columns`` of the stored rows whose key occurs in ``changes`` (one row per key); returns the number of partitions written.

    The keys and the partition column alone tell which partitions hold such rows; only these are read as a whole and written again.
    Their values pass the driver, which lists the table's folders anyway. The partition column cannot be changed. A null new value keeps
    the old one.
    """
    stored = spark.read.parquet(path)
    unknown = [c for c in columns if c not in stored.columns or c == by]
    if unknown:
        raise ValueError(f"cannot set {unknown}")
    changes = materialise(changes.select(*keys, *columns), "changes")
    touched = stored.select(*keys, by).join(changes.select(*keys), list(keys), "left_semi").select(by).distinct()
    values = [r[0] for r in touched.collect()]
    if not values:
        return 0
    within = F.col(by).isin([v for v in values if v is not None])
    held = stored.filter(within | F.col(by).isNull() if None in values else within)
    # written aside first: the files that are read are those to be replaced
    overwrite_partitions(materialise(keyed_update(held, changes, keys, columns), "updated"), path, by)
    return len(values)


def expire_in_place(spark: SparkSession, path: str, as_of: Column, seconds: int = 86_400, time: str = "timestamp", by: str = "day") -> int:
    """Remove rows with ``time`` at least ``seconds`` before ``as_of`` from a table partitioned by the date of ``time``.

    Folders of earlier days are deleted, the day that the limit falls on is written again, later days are not touched. Rows without
    a time stay. Returns the number of folders deleted or written.
    """
    end = as_of - F.expr(f"INTERVAL {int(seconds)} SECONDS")
    limit, day = spark.range(1).select(end.alias("end"), F.to_date(end).alias("day")).first()
    if limit is None:
        return 0
    stored = spark.read.parquet(path)
    gone = [r[0] for r in stored.filter(F.col(by) < F.lit(day)).select(by).distinct().collect()]
    edge = stored.filter(F.col(by) == F.lit(day))
    kept = materialise(edge.filter(F.col(time) > F.lit(limit)), "kept")
    n_edge, n_kept = edge.count(), kept.count()
    if n_kept and n_kept < n_edge:
        overwrite_partitions(kept, path, by)
    if n_edge and not n_kept:
        gone.append(day)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for value in gone:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={value}")
        folder.getFileSystem(conf).delete(folder, True)
    return len(gone) + (0 < n_kept < n_edge)
