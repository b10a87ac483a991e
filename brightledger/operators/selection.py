"""Splits, label codes and the selection steps of semi-supervised and active learning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions.geometry import argmax, entropy, second_max
from brightledger.operators.ordering import top_fraction, with_position
from brightledger.operators.rows import portable_hash

HASH_SPACE = 4294967296
LEAST_CONFIDENCE, MARGIN, ENTROPY = "least_confidence", "margin", "entropy"


def random_split(df: DataFrame, key: str, ratios: dict[str, float], seed: int = 42) -> DataFrame:
    """Split by a hash of the key: the same rows in the same part under any partitioning.

    All rows of a key fall in one part, so with a group key this is the group split.
    """
    u = portable_hash(F.col(key), seed) / F.lit(float(HASH_SPACE))
    total, acc, out = sum(ratios.values()), 0.0, None
    *head, last = ratios.items()
    for name, r in head:
        acc += r / total
        out = F.when(u < acc, name) if out is None else out.when(u < acc, name)
    return df.withColumn("split", F.lit(last[0]) if out is None else out.otherwise(last[0]))


def stratified_split(df: DataFrame, label: str, key: str, train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """Exactly ``int(n * ratio)`` rows of every label go to ``train``."""
    placed = with_position(df, [portable_hash(F.col(key), seed), key], by=[label], name="_idx", count_name="_n")
    part = F.when(F.col("_idx") < F.floor(F.col("_n") * F.lit(train_ratio)), "train").otherwise("test")
    return placed.withColumn("split", part).drop("_idx", "_n")


def label_codes(df: DataFrame, column: str, name: str = "code", fit_on: DataFrame | None = None) -> DataFrame:
    """0-based codes by sorted value, learned on ``fit_on``; values not learned give NULL."""
    values = (df if fit_on is None else fit_on).select(column).filter(F.col(column).isNotNull()).distinct()
    return df.join(with_position(values, [column], name=name), column, "left")


def pseudo_labels(df: DataFrame, probs: str, key: str, fraction: float) -> DataFrame:
    """The most confident rows with their predicted class."""
    return top_fraction(df, F.array_max(probs), fraction, [key]).withColumn("pseudo_label", argmax(F.col(probs)))


def pseudo_targets(df: DataFrame, guess: str, key: str, fraction: float) -> DataFrame:
    """Rows whose prediction lies farthest from the mean prediction."""
    mean = df.agg(F.avg(guess)).scalar()
    return top_fraction(df.withColumn("_mean", mean), F.abs(F.col(guess) - F.col("_mean")), fraction, [key]).drop("_mean")


def uncertainty(probs: str, strategy: str) -> Column:
    """Higher is less certain."""
    p = F.col(probs)
    if strategy == LEAST_CONFIDENCE:
        return -F.array_max(p)
    if strategy == MARGIN:
        return -(F.array_max(p) - second_max(p))
    if strategy == ENTROPY:
        return entropy(p)
    raise ValueError(f"unknown strategy {strategy!r}")


def most_uncertain(df: DataFrame, probs: str, key: str, strategy: str, n: int) -> DataFrame:
    """The ``n`` rows to ask labels for (a top-k report: each task keeps its own best n)."""
    return df.withColumn("uncertainty", uncertainty(probs, strategy)).orderBy(F.desc("uncertainty"), key).limit(n)


def extremes_by_size(df: DataFrame, value: str, name: Sequence[str] | str, n: int = 20) -> DataFrame:
    """Largest and smallest ``n`` by absolute value."""
    sized = df.withColumn("size", F.abs(value))
    top = sized.orderBy(F.desc("size"), name).limit(n).withColumn("end", F.lit("largest"))
    bottom = sized.orderBy("size", name).limit(n).withColumn("end", F.lit("smallest"))
    return top.unionByName(bottom)
