"""An index for vector search: inverted lists by coarse centres, residuals in one byte a dimension, exact re-ranking.

The index is two stored tables: ``centres`` (one row a list) and ``lists`` (one row a vector: its list, codes and the vector), stored
by list. A search reads the codes of the lists near each query, and the vectors of the best few only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightledger.session import materialise, scratch_path

#: Vectors that the centres are learned from, at most about; every vector is indexed.
FIT_VECTORS = 50_000
#: Vectors of a list that one task compares with a query block, and queries of a block.
PIECE, QUERY_BLOCK = 50_000, 1_000
LEVELS = 255


@dataclass
class VectorIndex:
    spark: SparkSession
    path: str
    centres: np.ndarray  # one row a list: bounded by the caller's number of lists
    low: np.ndarray      # range of the residuals by dimension
    step: np.ndarray
    ident: str
    kind: str

    def lists(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/lists")

    def sizes(self) -> DataFrame:
        return self.lists().groupBy("list").agg(F.count("*").alias("n"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has no null and no component that isn't a finite number; others are never found."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(F.col(vector).isNotNull() & ~odd)


def build(items: DataFrame, ident: str = "vec_id", vector: str = "embedding", n_lists: int = 64, path: str | None = None,
          fit_vectors: int = FIT_VECTORS, seed: int = 42) -> VectorIndex:
    """Index every usable row of ``items``. Centres come from about ``fit_vectors`` of them at most, residual ranges from all."""
    spark = items.sparkSession
    path = path or scratch_path(spark, "index")
    items = usable(items.select(F.col(ident).alias("id"), F.col(vector).cast("array<double>").alias("v")), "v")
    n = items.count()
    share = min(1.0, fit_vectors / max(1, n))
    fit = items.filter(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < share * (1 << 30)).select(array_to_vector("v").alias("features"))
    fit = materialise(fit, "fit")
    centres = np.array(KMeans(k=max(2, min(n_lists, n)), seed=seed, maxIter=10).fit(fit).clusterCenters())
    dims = centres.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (centres * centres).sum(axis=1)
        for b in batches:
            x = _matrix(b.column(1), dims)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((squares - 2 * x @ centres.T).argmin(axis=1), pa.int32())], names=["id", "v", "list"])

    kind = items.schema["id"].dataType.simpleString()
    placed = materialise(items.mapInArrow(assign, f"id {kind}, v array<double>, list int"), "placed")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dims, np.inf), np.full(dims, -np.inf)
        for b in batches:
            r = _matrix(b.column(1), dims) - centres[b.column(2).to_numpy()]
            low, high = np.minimum(low, r.min(axis=0)), np.maximum(high, r.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(low), pa.array(high)], names=["d", "low", "high"])

    seen = placed.mapInArrow(ranges, "d int, low double, high double").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()
    low = np.array([r["low"] for r in seen])
    step = np.maximum(np.array([r["high"] for r in seen]) - low, 1e-12) / LEVELS

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = _matrix(b.column(1), dims) - centres[b.column(2).to_numpy()]
            codes = np.clip(np.round((r - low) / step), 0, LEVELS).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), b.column(1)], names=["list", "id", "code", "v"])

    coded = placed.mapInArrow(code, f"list int, id {kind}, code binary, v array<double>")
    # a large list is written by several tasks
    pieces = placed.groupBy("list").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    coded.join(F.broadcast(pieces), "list").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")).drop("pieces").repartition(
        "list", "piece").write.partitionBy("list").parquet(f"{path}/lists")  # one row a list is broadcast
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centre array<double>").write.parquet(f"{path}/centres")
    return VectorIndex(spark, path, centres, low, step, ident, kind)


def search(index: VectorIndex, queries: DataFrame, k: int = 5, query: str = "query_id", vector: str = "embedding", probes: int = 8,
           keep: int = 10) -> DataFrame:
    """(query, item, distance, rank): the ``k`` nearest of the ``probes`` lists nearest to each query, by Euclidean distance.

    Codes decide which ``k * keep`` vectors are measured exactly. Queries without a usable vector find nothing. With as many
    probes as lists only the codes' rounding is left between this and an exact search.
    """
    centres, low, step, dims = index.centres, index.low, index.step, index.centres.shape[1]
    probes = min(probes, len(centres))
    q_kind = queries.schema[query].dataType.simpleString()
    asked = usable(queries.select(F.col(query).alias("q"), F.col(vector).cast("array<double>").alias("w")), "w")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (centres * centres).sum(axis=1)
        for b in batches:
            w = _matrix(b.column(1), dims)
            near = np.argpartition(squares - 2 * w @ centres.T, probes - 1, axis=1)[:, :probes]
            rows = pa.array(np.repeat(np.arange(b.num_rows), probes))
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(near.reshape(-1), pa.int32())], names=["q", "w", "list"])

    routed = materialise(asked.mapInArrow(route, f"q {q_kind}, w array<double>, list int"), "routed")
    probed = [r["list"] for r in routed.select("list").distinct().collect()]  # as many as lists at most
    stored = index.lists().filter(F.col("list").isin(probed)) if probed else index.lists().limit(0)
    blocks = materialise(routed.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks")), "blocks")
    pieces = materialise(stored.select("list", "piece").distinct(), "pieces")
    left = stored.select("list", "piece", "id", "code").join(blocks, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    right = routed.join(blocks, "list").withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int")).drop("blocks").join(pieces, "list")

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"q": b["q"][:0], "list": np.empty(0, np.int32), "id": a["id"][:0], "about": np.empty(0)})
        codes = np.frombuffer(b"".join(a["code"]), np.uint8).reshape(-1, dims)
        x = (low + codes * step).astype(np.float32)
        w = (np.array(b["w"].tolist()) - centres[b["list"].iloc[0]]).astype(np.float32)
        squares = (x * x).sum(axis=1)[None, :] - 2 * (w @ x.T) + (w * w).sum(axis=1)[:, None]
        m = min(k * keep, len(x))
        near = np.argpartition(squares, m - 1, axis=1)[:, :m]
        row = np.repeat(np.arange(len(w)), m)
        near = near.reshape(-1)
        return pd.DataFrame({"q": b["q"].to_numpy()[row], "list": np.int32(a["list"].iloc[0]), "id": a["id"].to_numpy()[near], "about": squares[row, near].astype(float)})

    keys = ["list", "piece", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, f"q {q_kind}, list int, id {index.kind}, about double")
    best = Window.partitionBy("q").orderBy("about", "id")
    few = materialise(found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k * keep).select("q", "list", "id"), "candidates")
    exact = few.join(stored.select("list", "id", "v"), ["list", "id"]).join(asked, "q")
    d = F.sqrt(F.aggregate(F.zip_with("v", "w", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    w = Window.partitionBy("q").orderBy("distance", "id")
    return exact.withColumn("distance", d).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        F.col("q").alias(query), F.col("id").alias(index.ident), "distance", "rank")


def compared(index: VectorIndex, queries: DataFrame, query: str = "query_id", vector: str = "embedding", probes: int = 8) -> DataFrame:
    """(compared, of): pairs of query and vector that a search of ``probes`` lists compares by code, and all pairs."""
    centres, dims = index.centres, index.centres.shape[1]
    asked = usable(queries.select(F.col(vector).cast("array<double>").alias("w")), "w")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (centres * centres).sum(axis=1)
        for b in batches:
            near = np.argpartition(squares - 2 * _matrix(b.column(0), dims) @ centres.T, min(probes, len(centres)) - 1, axis=1)[:, :probes]
            yield pa.RecordBatch.from_arrays([pa.array(near.reshape(-1), pa.int32())], names=["list"])

    hits = asked.mapInArrow(route, "list int").groupBy("list").agg(F.count("*").alias("asked"))
    total = index.sizes().agg(F.sum("n").alias("n")).scalar()
    return hits.join(index.sizes(), "list").agg(F.sum(F.col("asked") * F.col("n")).alias("compared"),
                                                (F.max(total) * F.sum("asked") / min(probes, len(centres))).cast("bigint").alias("of"))


def recall(found: DataFrame, truth: DataFrame, query: str = "query_id", item: str = "vec_id") -> DataFrame:
    """(recall,): the share of the rows of ``truth`` (query, item) that ``found`` has."""
    hit = truth.select(query, item).join(found.select(query, item, F.lit(1).alias("_hit")), [query, item], "left")
    return hit.agg((F.count("_hit") / F.count("*")).alias("recall"))
