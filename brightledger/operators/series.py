"""Long ordered series: trailing means, lead differences, lookback windows, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.operators.ordering import over_row_frames, with_position


def trailing_row_mean(df: DataFrame, order: Sequence[str], value: str, rows: int = 7, by: Sequence[str] = (),
                      name: str = "trailing_mean", block_rows: int = 100_000) -> DataFrame:
    """Mean of the ``rows`` rows before this one; NULL until that many exist."""
    def add(frame, w):
        before = w.rowsBetween(-rows, -1)
        return frame.withColumn(name, F.when(F.count(value).over(before) == rows, F.avg(value).over(before)))

    return over_row_frames(df, order, rows, 0, add, by, block_rows)


def lead_difference(df: DataFrame, order: Sequence[str], value: str, horizon: int = 1, by: Sequence[str] = (),
                    name: str = "change", block_rows: int = 100_000) -> DataFrame:
    """Value ``horizon`` rows ahead minus this one; the trailing rows without it are dropped."""
    out = over_row_frames(df, order, 0, horizon, lambda frame, w: frame.withColumn(
        name, F.lead(value, horizon).over(w) - F.col(value)), by, block_rows)
    return out.filter(F.col(name).isNotNull())


def lookback_windows(df: DataFrame, order: Sequence[str], features: Sequence[str], target: str, lookback: int = 60,
                     by: Sequence[str] = (), block_rows: int = 100_000) -> DataFrame:
    """Array of the previous ``lookback`` rows' features with the current target; short starts dropped.

    Each array has a fixed length, so rows stay small whatever the series length.
    """
    def add(frame, w):
        past = F.collect_list(F.struct(*features)).over(w.rowsBetween(-lookback, -1))
        return frame.withColumn("window", past).withColumn("target", F.col(target))

    out = over_row_frames(df, order, lookback, 0, add, by, block_rows)
    return out.filter(F.size("window") == lookback).select(*by, *order, "window", "target")


def chronological_split(df: DataFrame, order: Sequence[str], ratios: Sequence[float] = (0.7, 0.15, 0.15),
                        names: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    """Split by position at ``int(n * ratio)`` marks; the last part takes the rest."""
    placed = with_position(df, order, name="_idx", count_name="_n")
    first = F.floor(F.col("_n") * F.lit(ratios[0]))
    second = F.floor(F.col("_n") * F.lit(ratios[0] + ratios[1]))
    part = F.when(F.col("_idx") < first, names[0]).when(F.col("_idx") < second, names[1]).otherwise(names[2])
    return placed.withColumn("split", part).drop("_idx", "_n")


def row_names(df: DataFrame, order: Sequence[str], pattern: str = "plate_%04d", name: str = "row_name") -> DataFrame:
    return with_position(df, order, name="_idx").withColumn(name, F.format_string(pattern, "_idx")).drop("_idx")
