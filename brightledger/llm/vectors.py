"""Near-duplicate embeddings found by a forest of random-projection trees.

Every tree splits recursively: a node's direction and quantile follow from a hash of the node, directions come from a seeded
pool, quantiles from a bounded sample. Rows within the spill margin of a split go both ways, so a close pair is parted at a
level with a chance below one in a hundred; several trees make a miss of all of them vanishingly rare.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import batch, map_arrow, read
from brightledger.llm.components import connected_components
from brightledger.session import materialise

import pyarrow as pa

COSINE = 0.98
TREES, DIRECTIONS, SEED = 4, 256, 42
#: Vectors whose projections give the quantiles: the only thing that is sampled.
SAMPLE = 4_000
#: Expected rows of a leaf in the largest label, and rows that one task compares at once.
LEAF, PIECE = 256, 2_048
#: Half width of the margin, in standard deviations of the projected difference of a pair at the least cosine.
SPILL = 0.8
QUANTILES = np.linspace(0.3, 0.7, 17)
TREE_BITS = 50


def units(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def directions(tree: int, size: int) -> np.ndarray:
    d = np.random.default_rng([SEED, tree, size]).standard_normal((size, DIRECTIONS))
    return d / np.sqrt((d * d).sum(axis=0))


def cuts(sample: list, trees: int) -> dict[int, np.ndarray]:
    """By vector size: quantiles of the sample's projections, tree x direction x quantile. A bounded table."""
    by_size: dict[int, list] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(v)
    return {n: np.stack([np.quantile(units(vs) @ directions(t, n), QUANTILES, axis=0).T for t in range(trees)]) for n, vs in by_size.items()}


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def leaves(x: np.ndarray, tree: int, depth: int, table: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf code) of unit vectors in one tree; a row in a margin has several leaves."""
    projected = x @ directions(tree, x.shape[1])
    margin = SPILL * math.sqrt(2 - 2 * cosine) / math.sqrt(x.shape[1])
    rows, node = np.arange(len(x)), np.ones(len(x), np.int64)
    for _ in range(depth):
        h = _mix(node, tree)
        way = (h % np.uint64(DIRECTIONS)).astype(int)
        at = projected[rows, way] - table[tree][way, ((h >> np.uint64(20)) % np.uint64(len(QUANTILES))).astype(int)]
        left, right = at <= margin, at > -margin
        rows, node = np.r_[rows[left], rows[right]], np.r_[2 * node[left], 2 * node[right] + 1]
    return rows, node + (tree << TREE_BITS)


def forest(adjacent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what a symmetric matrix of links joins: one fewer than the rows of each class."""
    left, parents, children = np.flatnonzero(adjacent.any(axis=1)), [], []
    while left.size:
        front, left = left[:1], left[1:]
        while front.size and left.size:
            near = adjacent[np.ix_(left, front)]
            hit = near.any(axis=1)
            parents.append(front[near[hit].argmax(axis=1)])
            children.append(left[hit])
            front, left = left[hit], left[~hit]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *parents]), np.concatenate([none, *children])


def compared(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Of one unit of work (a leaf, or two pieces of a crowded one): links a node gets (b null) and links that join (a, b).

    A pair that shares an earlier leaf is left to that leaf, so each pair counts once. Vectors of other sizes never meet.
    """
    out = []
    for _, part in rows.groupby(rows["embedding"].map(len)):
        part = part.sort_values("nid")
        nid, n = part["nid"].to_numpy(), part["n"].to_numpy()
        piece, i, j = part["piece"].to_numpy(), part["i"].iloc[0], part["j"].iloc[0]
        x = units(part["embedding"])
        linked = x @ x.T >= cosine
        np.fill_diagonal(linked, False)
        if i != j:
            linked &= piece[:, None] != piece[None, :]
        some = np.flatnonzero(linked.any(axis=1))
        if not some.size:
            continue
        linked, nid, n = linked[np.ix_(some, some)], nid[some], n[some]
        codes = part["earlier"].to_numpy()[some]
        known, at = np.unique(np.concatenate([np.asarray(c, np.int64) for c in codes]), return_inverse=True)
        if known.size:
            member = np.zeros((len(some), known.size), np.float32)
            member[np.repeat(np.arange(len(some)), [len(c) for c in codes]), at] = 1
            linked &= member @ member.T == 0
        a, b = forest(linked)
        has = linked.any(axis=1)
        out.append(pd.DataFrame({"a": nid[has], "b": pd.array([None] * has.sum(), "Int64"), "links": (linked @ n)[has]}))
        out.append(pd.DataFrame({"a": nid[a], "b": pd.array(nid[b], "Int64"), "links": 0}))
    return pd.concat(out) if out else pd.DataFrame({"a": pd.array([], "Int64"), "b": pd.array([], "Int64"), "links": pd.array([], "Int64")})


def usable(vector):
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(table: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, piece: int = PIECE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table`` (vec_id, embedding, label; others are ignored).

    Only rows of equal labels are compared. Null labels, and vectors that are null, empty, zero or hold null or non-finite
    components, link with nothing. Equal vectors are one node with a weight, so copies are never compared with each other;
    a crowded leaf is compared piece by piece over many tasks. A null vec_id counts as a link of others but never names a
    component; its row is not kept unless alone with null ids.
    """
    rows = table.select("vec_id", "embedding", "label").withColumn("_ok", usable(F.col("embedding")) & F.col("label").isNotNull())
    good = rows.filter("_ok").drop("_ok")
    nodes = good.groupBy("label", "embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    nodes = materialise(nodes.withColumn("nid", F.monotonically_increasing_id()), "vectors")
    sample = [r[0] for r in nodes.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE).collect()]
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, most) / leaf)))
    tables = nodes.sparkSession.sparkContext.broadcast(cuts(sample, trees))

    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = f"label {kinds['label']}, code bigint, nid bigint, n bigint, embedding {kinds['embedding']}, earlier array<bigint>"

    def place(batches):
        for b in batches:
            label, vectors, n, nid = (b.column(b.schema.names.index(c)) for c in ("label", "embedding", "n", "nid"))
            listed = vectors.to_pylist()
            size = np.array([len(v) for v in listed])
            for s in np.unique(size):
                own = np.flatnonzero(size == s)
                x = units([listed[k] for k in own])
                table = tables.value.get(int(s))
                if table is None:
                    table = np.zeros((trees, DIRECTIONS, len(QUANTILES)))
                pairs = [leaves(x, t, depth, table, cosine) for t in range(trees)]
                row, code = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
                order = np.lexsort((code, row))
                row, code = row[order], code[order]
                start = np.searchsorted(row, np.arange(len(own)))
                earlier = [code[start[r]:k] for k, r in enumerate(row)]
                take = pa.array(own[row])
                yield pa.RecordBatch.from_arrays(
                    [label.take(take), pa.array(code), nid.take(take), n.take(take), vectors.take(take), pa.array(earlier, pa.list_(pa.int64()))],
                    names=["label", "code", "nid", "n", "embedding", "earlier"])

    placed = map_arrow(nodes.select("label", "embedding", "n", "nid"), place, schema)
    crowded = materialise(placed.groupBy("label", "code").agg(F.count("*").alias("_in")).filter(F.col("_in") > piece).select(
        "label", "code", F.ceil(F.col("_in") / piece).cast("int").alias("_pieces")), "crowded")
    dealt = placed.join(crowded, ["label", "code"], "left").withColumn("_pieces", F.coalesce("_pieces", F.lit(1)))
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("nid"), F.col("_pieces")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    dealt = dealt.withColumn("i", F.least("piece", "_other")).withColumn("j", F.greatest("piece", "_other"))
    units_of_work = dealt.select("label", "code", "i", "j", "piece", "nid", "n", "embedding", "earlier").groupBy("label", "code", "i", "j")
    found = materialise(units_of_work.applyInPandas(lambda g: compared(g, cosine), "a bigint, b bigint, links bigint"), "near")

    links = found.filter("b is null").groupBy(F.col("a").alias("nid")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "nid")
    classes = nodes.select("nid", "first", "n").join(links, "nid", "left").join(roots, "nid", "left")
    classes = materialise(classes.select("nid", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                         F.coalesce("root", "nid").alias("root")), "classes")
    named = classes.join(classes.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("nid", "n_links", "component_id")
    known = nodes.select("nid", "label", "embedding").join(named, "nid").drop("nid")
    done = good.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not _ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_vectors(spark, folder):
    return near_duplicates(read(spark, folder, "embeddings"))
