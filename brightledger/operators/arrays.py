"""Scaling, trends and multi-label encoding over whole columns.

Global statistics enter as one-row scalar subqueries, never as a joined or collected table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_range(df: DataFrame, column: str):
    s = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    return s.getField("lo"), s.getField("hi")


def min_max_scaled(df: DataFrame, column: str, name: str, restored: str | None = None,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Scale to 0..1 by the range of ``fit_on`` (default: the frame). A constant column gives 0."""
    lo, hi = column_range(df if fit_on is None else fit_on, column)
    out = df.withColumn("_lo", lo).withColumn("_hi", hi)
    span = F.col("_hi") - F.col("_lo")
    out = out.withColumn(name, F.when(span == 0, 0.0).otherwise((F.col(column) - F.col("_lo")) / span))
    if restored:
        out = out.withColumn(restored, F.col(name) * span + F.col("_lo"))
    return out.drop("_lo", "_hi")


def standardised(df: DataFrame, column: str, name: str, fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column gives 0."""
    s = (df if fit_on is None else fit_on).agg(
        F.struct(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"))).scalar()
    out = df.withColumn("_s", s)
    z = (F.col(column) - F.col("_s.m")) / F.col("_s.s")
    return out.withColumn(name, F.when(F.col("_s.s") == 0, 0.0).otherwise(z)).drop("_s")


def with_trend(df: DataFrame, x: str, y: str, name: str = "trend") -> DataFrame:
    """Least-squares line of ``y`` on ``x``, evaluated on every row."""
    fit = df.agg(F.struct(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("icpt"))).scalar()
    return df.withColumn("_f", fit).withColumn(name, F.col("_f.icpt") + F.col("_f.slope") * F.col(x)).drop("_f")


def learn_labels(df: DataFrame, column: str) -> DataFrame:
    """Distinct labels of a list column, one row each: a table that may grow with the data."""
    return df.select(F.explode(column).alias("label")).distinct()


def multi_hot_rows(df: DataFrame, key: str, column: str, labels: DataFrame) -> DataFrame:
    """The sparse form of multi-hot encoding: (key, label) for every learned label that a row has."""
    return df.select(key, F.explode(F.array_distinct(column)).alias("label")).join(labels, "label", "left_semi").select(key, "label")


def multi_hot(df: DataFrame, column: str, labels: Sequence[str], prefix: str = "") -> DataFrame:
    """One 0/1 column per label of the caller's list; other labels are ignored."""
    return df.withColumns({f"{prefix}{v}": F.array_contains(column, v).cast("int") for v in labels})
