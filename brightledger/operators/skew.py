"""Equi-joins that survive a key holding a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot keys by the number of partitions each is spread over: salts (a power of two) -> hashes of keys.
HotKeys = dict[int, list[int]]


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def task_rows(df: DataFrame, n: int) -> int:
    """Rows of an even shuffle partition of ``n`` rows."""
    return max(1, math.ceil(n / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> HotKeys:
    """Keys with more rows than an even shuffle partition has, with salts in proportion to their rows.

    There are fewer of them than shuffle partitions. Frequent-item counters find every such key in one pass over the
    key columns, without a shuffle; a second pass counts those few candidates.
    """
    hashed = df.select(key_hash(keys).alias("h"))
    support = max(1e-4, min(0.5, 1.0 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    candidates = hashed.freqItems(["h"], support).first()[0]
    if not candidates:
        return {}
    rows = hashed.groupBy(F.when(F.col("h").isin(*candidates), F.col("h")).alias("h")).agg(F.count("*").alias("n")).collect()
    each = task_rows(df, sum(r["n"] for r in rows))
    hot: HotKeys = {}
    for r in rows:
        if r["h"] is not None and r["n"] > each:
            hot.setdefault(1 << (math.ceil(r["n"] / each) - 1).bit_length(), []).append(r["h"])
    return hot


def hot_counted(counts: DataFrame, key: str, n: str) -> HotKeys:
    """As ``hot_keys``, from a table that has one row for each key and the number of its rows."""
    total = counts.agg(F.sum(n)).first()[0]
    if not total:
        return {}
    each = task_rows(counts, total)
    hot: HotKeys = {}
    for r in counts.filter(F.col(n) > each).select(key_hash([key]).alias("h"), F.col(n).alias("n")).collect():
        hot.setdefault(1 << (math.ceil(r["n"] / each) - 1).bit_length(), []).append(r["h"])
    return hot


def _salts(keys: Sequence[str], hot: Mapping[int, Sequence[int]]) -> Column:
    """Number of salts of a row's key; 1 for keys that aren't hot."""
    out = F.lit(1)
    for n, hashes in hot.items():
        out = F.when(key_hash(keys).isin(*hashes), n).otherwise(out)
    return out


def spreadable(df: DataFrame) -> list[str]:
    """Columns that can be hashed: those without a map."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def salted(df: DataFrame, keys: Sequence[str], hot: Mapping[int, Sequence[int]], spread_by: Sequence[str]) -> DataFrame:
    """Add ``_salt``: rows of hot keys are spread by a hash (a retried task repeats its output)."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), _salts(keys, hot)).cast("int"))


def copied(df: DataFrame, keys: Sequence[str], hot: Mapping[int, Sequence[int]]) -> DataFrame:
    """Counterpart of ``salted``: only rows of hot keys are copied, once per salt."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), _salts(keys, hot) - 1)))


def salted_join(big: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", hot: Mapping[int, Sequence[int]] | None = None,
                spread_by: Sequence[str] | None = None) -> DataFrame:
    """Join with the rows of hot keys of ``big`` spread over several partitions.

    ``hot`` is the result of ``hot_keys`` where it is already known (a base table whose key runs
    through several joins); otherwise it is found here. Without hot keys this is a plain join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    keys = list(keys)
    if hot is None:
        hot = hot_keys(big, keys)
    if not hot:
        return big.join(other, keys, how)
    left = salted(big, keys, hot, spread_by or spreadable(big))
    return left.join(copied(other, keys, hot), [*keys, "_salt"], how).drop("_salt")
