"""K-means reports, exact density clustering in the plane, cluster filters."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.operators.components import connected_components
from brightledger.operators.ordering import with_position
from brightledger.operators.rows import portable_hash
from brightledger.operators.skew import hot_keys, salted_join
from brightledger.session import materialise

NOISE = -1


def inertia_by_k(df: DataFrame, ks: range = range(1, 11), column: str = "features", seed: int = 42) -> DataFrame:
    """Sum of squared distances to the centres for each k; k = 1 is the total variance."""
    size = df.select(column).first()[0].size
    rows = []
    for k in ks:
        if k == 1:
            v = vector_to_array(column)
            cost = df.agg(sum((F.var_pop(v[i]) for i in range(size)), F.lit(0.0)).alias("v"), F.count("*").alias("n")).first()
            rows.append((1, cost["v"] * cost["n"]))
        else:
            rows.append((k, float(KMeans(k=k, seed=seed, featuresCol=column).fit(df).summary.trainingCost)))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def silhouette_by_k(df: DataFrame, ks: range = range(2, 11), column: str = "features", seed: int = 42) -> DataFrame:
    """Silhouette (squared Euclidean, linear in the rows) of each k-means clustering, over all rows."""
    rows = []
    evaluator = ClusteringEvaluator(featuresCol=column, metricName="silhouette", distanceMeasure="squaredEuclidean")
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol=column).fit(df)
        rows.append((k, float(evaluator.evaluate(model.transform(df)))))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


#: Rows whose silhouettes are averaged at most, and numbers (rows x coordinates) that this sample may hold.
SAMPLE_ROWS, SAMPLE_NUMBERS = 10_000, 1 << 24
#: Sampled rows that one step compares with an Arrow batch.
SAMPLE_BLOCK = 1_000


def silhouettes(df: DataFrame, labels: Sequence[str], key: str = "id", vector: str = "vector", sample: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """(labelling, key, cluster, own, nearest, silhouette) in plain Euclidean distance for a seeded sample of rows, against all rows.

    ``vector`` is an array of doubles, ``labels`` name columns of whole-numbered cluster labels: one pass serves all labellings. The
    sample (at most ``sample`` rows, the smallest seeded hashes of the key) is sent to every task; a task adds up the distances of its
    rows to each sampled row by labelling and cluster, as matrix products, and passes on these sums alone. ``own`` is the mean distance to
    the other rows of the row's cluster, ``nearest`` the smallest mean distance to another cluster; a row alone in its cluster has 0.
    Rows without a vector or label are left out of that labelling.
    """
    labels = list(labels)
    rows = df.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"), *[F.col(c).cast("bigint").alias(c) for c in labels]).filter("_v is not null")
    chosen = rows.withColumn("_h", portable_hash(F.col("_id"), seed)).orderBy("_h", "_id").limit(sample).drop("_h")
    held = chosen.collect()
    if sum(len(r["_v"]) for r in held) > SAMPLE_NUMBERS:
        raise ValueError("the sample holds too many numbers: ask for fewer rows")
    points = df.sparkSession.sparkContext.broadcast(np.array([r["_v"] for r in held], np.float64))
    ids = [r["_id"] for r in held]
    same = df.sparkSession.sparkContext.broadcast({k: i for i, k in enumerate(ids)})

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], np.ndarray] = {}
        at = points.value
        squares = (at * at).sum(axis=1)
        for b in batches:
            x = np.stack(b["_v"].to_numpy())
            own = np.array([same.value.get(k, -1) for k in b["_id"]])
            marks = []
            for i, c in enumerate(labels):
                known = b[c].notna().to_numpy()
                values, index = np.unique(b[c][known].to_numpy(np.int64), return_inverse=True)
                one = np.zeros((len(values), len(b)))
                one[index, np.flatnonzero(known)] = 1
                marks += [((i, int(v)), row) for v, row in zip(values, one)]
            if not marks:
                continue
            each = np.stack([row for _, row in marks])
            for start in range(0, len(at), SAMPLE_BLOCK):
                part = slice(start, start + SAMPLE_BLOCK)
                d = (x * x).sum(axis=1)[:, None] - 2 * x @ at[part].T
                d += squares[part]
                d = np.sqrt(np.maximum(d, 0))
                mine = np.flatnonzero((own >= start) & (own < start + SAMPLE_BLOCK))
                d[mine, own[mine] - start] = 0  # a row's distance to itself, free of rounding
                for (mark, _), found in zip(marks, each @ d):
                    total.setdefault(mark, np.zeros(len(at)))[part] += found
        for (i, v), found in total.items():
            yield pd.DataFrame({"_l": i, "_c": v, "_s": np.arange(len(found)), "_d": found})

    parts = rows.mapInPandas(sums, "_l int, _c bigint, _s int, _d double")
    added = parts.groupBy("_l", "_c", "_s").agg(F.sum("_d").alias("_d"))
    marks = F.array(*[F.struct(F.lit(i).alias("_l"), F.lit(c).alias("labelling"), F.col(c).alias("_c")) for i, c in enumerate(labels)])
    sizes = rows.select(F.inline(marks)).filter("_c is not null").groupBy("_l", "_c").agg(F.count("*").alias("_n"))
    kind = rows.schema["_id"].dataType.simpleString()
    order = {k: i for i, k in enumerate(ids)}
    of = df.sparkSession.createDataFrame([(i, k) for k, i in order.items()], f"_s int, _id {kind}")
    asked = chosen.join(of, "_id").select("_s", "_id", F.inline(marks)).withColumnRenamed("_c", "cluster").filter("cluster is not null")
    met = asked.join(added, ["_l", "_s"]).join(sizes, ["_l", "_c"])
    inside = F.col("_c") == F.col("cluster")
    out = met.groupBy("labelling", F.col("_id").alias(key), "cluster").agg(
        F.max(F.when(inside & (F.col("_n") > 1), F.col("_d") / (F.col("_n") - 1))).alias("own"),
        F.min(F.when(~inside, F.col("_d") / F.col("_n"))).alias("nearest"))
    return out.withColumn("silhouette", F.when(F.col("own").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("nearest") - F.col("own"), F.greatest("own", "nearest")), F.lit(0.0))))


def plain_silhouette_by_k(df: DataFrame, ks: range = range(2, 11), key: str = "id", column: str = "features", sample: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """Mean silhouette in plain Euclidean distance of each k-means clustering, over a seeded sample of rows against all rows."""
    labelled = df.select(key, column)
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol=column, predictionCol=f"k{k}").fit(df)
        labelled = model.transform(labelled)
    stage = materialise(labelled.withColumn("vector", vector_to_array(column)).drop(column), "labelled")
    found = silhouettes(stage, [f"k{k}" for k in ks], key, "vector", sample, seed)
    return found.groupBy(F.substring("labelling", 2, 9).cast("int").alias("k")).agg(F.avg("silhouette").alias("silhouette"))


def _distance2(a: str, b: str) -> Column:
    dx, dy = F.col(f"{a}x") - F.col(f"{b}x"), F.col(f"{a}y") - F.col(f"{b}y")
    return dx * dx + dy * dy


def _around(reach: int = 2) -> Column:
    """The cells within two steps, as (cx, cy) structs around the row's own cell."""
    steps = [F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy"))
             for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)]
    return F.array(*steps)


def _dense_links(points: DataFrame, dense: DataFrame, cell: float, eps: float, hot, max_level: int = 24) -> DataFrame:
    """Pairs of neighbouring dense cells that hold two points within ``eps``.

    Cells are halved level by level. A pair of part cells surely within reach settles its cell pair, one
    surely out of reach is dropped, and only the undecided are halved again, until few enough
    point pairs are left to be compared one by one.
    """
    pairs = dense.select("cx", "cy", F.col("node").alias("a"), F.explode(_around()).alias("o")).select(
        "a", F.col("o.cx").alias("cx"), F.col("o.cy").alias("cy")).join(
        dense.select("cx", "cy", F.col("node").alias("b")), ["cx", "cy"]).filter("a < b").select("a", "b")
    undecided = materialise(pairs, "pairs")
    n_points = points.count()
    members = salted_join(points, dense.select("cx", "cy", "node"), ["cx", "cy"], hot=hot, spread_by=["id"]).select("node", "x", "y").distinct()
    members = materialise(members, "members")
    crowded = hot_keys(members, ["node"])
    links = None
    budget = 10 * max(n_points, 1_000)
    for level in range(1, max_level + 1):
        if undecided.isEmpty():
            return links if links is not None else undecided.select("a", "b")
        width = cell / 2 ** level
        involved = undecided.select(F.col("a").alias("node")).union(undecided.select("b")).distinct()
        parts = salted_join(members, involved, ["node"], "left_semi", crowded, ["x", "y"]).groupBy(
            "node", F.floor(F.col("x") / width).alias("sx"), F.floor(F.col("y") / width).alias("sy")).agg(F.count("*").alias("n"))
        up_x, up_y = F.floor(F.col("sx") / 2), F.floor(F.col("sy") / 2)
        a = parts.select(F.col("node").alias("a"), F.col("sx").alias("ax"), F.col("sy").alias("ay"), F.col("n").alias("na"),
                         up_x.alias("pax"), up_y.alias("pay"))
        b = parts.select(F.col("node").alias("b"), F.col("sx").alias("bx"), F.col("sy").alias("by"), F.col("n").alias("nb"),
                         up_x.alias("pbx"), up_y.alias("pby"))
        if level == 1:
            joined = undecided.join(a, "a").join(b, "b")
        else:
            joined = undecided.join(a, ["a", "pax", "pay"]).join(b, ["b", "pbx", "pby"])
        gap = lambda p, q: F.greatest(F.abs(F.col(p) - F.col(q)) - 1, F.lit(0)) * F.lit(width)
        span = lambda p, q: (F.abs(F.col(p) - F.col(q)) + 1) * F.lit(width)
        near = F.sqrt(F.pow(gap("ax", "bx"), F.lit(2)) + F.pow(gap("ay", "by"), F.lit(2)))
        far = F.sqrt(F.pow(span("ax", "bx"), F.lit(2)) + F.pow(span("ay", "by"), F.lit(2)))
        judged = materialise(joined.select("a", "b", "ax", "ay", "bx", "by", "na", "nb", near.alias("near"), far.alias("far")).filter(
            F.col("near") <= eps * (1 + 1e-9)), "judged")
        sure = judged.filter(F.col("far") <= eps * (1 - 1e-9)).select("a", "b").distinct()
        links = sure if links is None else links.unionByName(sure)
        open_pairs = judged.join(sure, ["a", "b"], "left_anti")
        undecided = materialise(open_pairs.select("a", "b", F.col("ax").alias("pax"), F.col("ay").alias("pay"),
                                                  F.col("bx").alias("pbx"), F.col("by").alias("pby"), "na", "nb"), "pairs")
        left = undecided.agg(F.sum(F.col("na").cast("double") * F.col("nb"))).first()[0] or 0.0
        if left <= budget or level == max_level:
            at = lambda n, p: members.select(F.col("node").alias(n), F.floor(F.col("x") / width).alias(f"p{p}x"),
                                             F.floor(F.col("y") / width).alias(f"p{p}y"), F.col("x").alias(f"{p}x"), F.col("y").alias(f"{p}y"))
            exact = undecided.select("a", "b", "pax", "pay", "pbx", "pby").join(at("a", "a"), ["a", "pax", "pay"]).join(
                at("b", "b"), ["b", "pbx", "pby"]).filter(_distance2("a", "b") <= eps * eps).select("a", "b").distinct()
            return links.unionByName(exact)
        undecided = undecided.drop("na", "nb")
    return links


def density_clusters(df: DataFrame, eps: float, min_samples: int, key: str = "id", x: str = "x", y: str = "y") -> DataFrame:
    """Exact density clustering of points in the plane: (key, label), noise is -1.

    Clusters are numbered by their smallest core key; a border point joins the lowest numbered
    cluster in reach. Points meet on a grid whose cell diagonal is ``eps``: a cell with
    ``min_samples`` points is core as a whole, so only points of thin cells (fewer than
    ``min_samples`` each) are ever compared with the points around them, and crowded cells
    are compared with each other by halving, not pair by pair.
    """
    cell = eps / math.sqrt(2) * (1 - 1e-9)
    pts = materialise(df.select(F.col(key).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).withColumns(
        {"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)}), "points")
    cells = materialise(pts.groupBy("cx", "cy").agg(F.count("*").alias("n"), F.min("id").alias("node")), "cells")
    dense = cells.filter(F.col("n") >= min_samples)
    thin_cells = cells.filter(F.col("n") < min_samples)
    hot = hot_keys(pts, ["cx", "cy"])
    crowd = salted_join(pts, dense.select("cx", "cy", "node"), ["cx", "cy"], hot=hot, spread_by=["id"])
    thin = materialise(pts.join(thin_cells.select("cx", "cy"), ["cx", "cy"], "left_semi"), "thin")
    asks = thin.select(F.col("id").alias("p_id"), F.col("x").alias("px"), F.col("y").alias("py"), F.explode(_around()).alias("o")).select(
        "p_id", "px", "py", F.col("o.cx").alias("cx"), F.col("o.cy").alias("cy"))
    within = F.pow(F.col("px") - F.col("x"), F.lit(2)) + F.pow(F.col("py") - F.col("y"), F.lit(2)) <= eps * eps
    # thin point -> crowded cell: how many of its points are in reach
    to_crowd = materialise(salted_join(crowd, asks, ["cx", "cy"], hot=hot, spread_by=["id"]).filter(within).groupBy("p_id", "node").agg(
        F.count("*").alias("c")), "reach")
    # thin point -> thin point: both cells hold fewer than min_samples points
    to_thin = materialise(asks.join(thin, ["cx", "cy"]).filter(within).select("p_id", F.col("id").alias("q_id")), "reach")
    counts = to_crowd.select("p_id", "c").union(to_thin.select("p_id", F.lit(1).cast("bigint"))).groupBy("p_id").agg(F.sum("c").alias("c"))
    core_thin = counts.filter(F.col("c") >= min_samples).select(F.col("p_id").alias("id"))
    core_thin = materialise(thin.join(core_thin, "id", "left_semi"), "core")
    # a cell's node: the smallest core id in it
    thin_nodes = core_thin.groupBy("cx", "cy").agg(F.min("id").alias("node"))
    core_of = materialise(core_thin.join(thin_nodes, ["cx", "cy"]).select("id", "node"), "core")
    nodes = dense.select("node").union(thin_nodes.select("node"))
    as_p, as_q = core_of.select(F.col("id").alias("p_id"), F.col("node").alias("a")), core_of.select(F.col("id").alias("q_id"), F.col("node").alias("b"))
    links = to_crowd.join(as_p, "p_id").select("a", F.col("node").alias("b"))
    links = links.union(to_thin.join(as_p, "p_id").join(as_q, "q_id").select("a", "b"))
    links = links.union(_dense_links(pts, dense, cell, eps, hot).select("a", "b"))
    roots = materialise(connected_components(nodes, links), "roots")
    numbers = with_position(roots.select("root").distinct(), ["root"], name="label")
    labelled = materialise(roots.join(numbers, "root").select("node", "label"), "labels")
    crowd_labels = crowd.select("id", "node").join(labelled, "node").select("id", "label")
    core_labels = core_of.join(labelled, "node").select("id", "label")
    border = to_crowd.join(labelled, "node").select("p_id", "label").union(
        to_thin.join(core_labels.withColumnRenamed("id", "q_id"), "q_id").select("p_id", "label")).groupBy(
        F.col("p_id").alias("id")).agg(F.min("label").alias("label"))
    border = border.join(core_of.select("id"), "id", "left_anti")
    found = crowd_labels.union(core_labels).union(border.select("id", "label"))
    return pts.select("id").join(found, "id", "left").select(
        F.col("id").alias(key), F.coalesce(F.col("label").cast("int"), F.lit(NOISE)).alias("label"))


def cluster_counts(labels: DataFrame, label: str = "label") -> DataFrame:
    """Number of clusters and of noise points."""
    return labels.agg(F.count_distinct(F.when(F.col(label) != NOISE, F.col(label))).alias("n_clusters"),
                      F.count_if(F.col(label) == NOISE).alias("n_noise"))


def noise_as_bucket(df: DataFrame, label: str = "label") -> DataFrame:
    """Noise gets the number after the largest label."""
    top = df.agg(F.max(label)).scalar()
    return df.withColumn("_top", top).withColumn(
        label, F.when(F.col(label) == NOISE, F.col("_top") + 1).otherwise(F.col(label))).drop("_top")


def cluster_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return noise_as_bucket(df, label).groupBy(label).agg(F.count("*").alias("n"))


def keep_mid_sized(df: DataFrame, low: int, high: int, label: str = "label") -> DataFrame:
    """Labels of clusters with ``low < size < high`` stay; all others become 0."""
    marked = noise_as_bucket(df, label)
    valid = marked.groupBy(label).agg(F.count("*").alias("_n")).filter((F.col("_n") > low) & (F.col("_n") < high))
    valid = valid.select(F.col(label).alias("_valid"))
    return marked.join(valid, F.col(label) == F.col("_valid"), "left").withColumn(
        label, F.when(F.col("_valid").isNotNull(), F.col(label)).otherwise(0)).drop("_valid")
