"""Exact density clustering of points with any number of coordinates.

Points lie in cells whose diagonal is the radius. Only cells that hold points exist; which of them are within reach of a point or
a box is found coordinate by coordinate, from the cells' prefixes, so nothing is made for the (2 sqrt(d) + 3)^d cells around one.
A cell of enough points is core as a whole: its points are never compared with each other. Such cells are joined along the axes
first, by a point of each; what is joined needs no further links. Only cells outside the largest group so made are then compared
with those around them that are not of their group, by halving, box against box, until a pair within reach is found or none can be.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.operators.clustering import NOISE
from brightledger.operators.components import connected_components
from brightledger.operators.ordering import with_position
from brightledger.operators.skew import hot_keys, salted_join
from brightledger.session import materialise

#: Rounding that bounds allow for; points themselves are compared without any.
SLACK = 1e-9


def _sum(columns: Sequence[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def _distance2(n: int, a: str = "p", b: str = "x") -> Column:
    return _sum([(F.col(f"{a}{i}") - F.col(f"{b}{i}")) * (F.col(f"{a}{i}") - F.col(f"{b}{i}")) for i in range(n)])


def cell_tree(cells: DataFrame, n: int) -> list[DataFrame]:
    """A table for each coordinate: (up, v, node, lo, hi), the prefixes of ``cells`` (columns cell, c, lo0, hi0 ...) by one coordinate more.

    A prefix goes by the smallest cell in it; lo and hi bound its cells in the coordinate that it ends in.
    """
    levels, above = [], None
    for k in range(n):
        here = cells.groupBy(F.slice("c", 1, k + 1).alias("p")).agg(F.min("cell").alias("node"), F.min(f"lo{k}").alias("lo"), F.max(f"hi{k}").alias("hi"))
        if above is not None:
            here = here.withColumn("q", F.slice("p", 1, k)).join(above.select(F.col("p").alias("q"), F.col("node").alias("up")), "q").drop("q")
        above = materialise(here.withColumn("v", F.col("p")[k]), "prefixes")
        levels.append(above.drop("p"))
    return levels


def cells_in_reach(asked: DataFrame, levels: Sequence[DataFrame], side: float, eps: float, low: str = "lo", high: str = "hi") -> DataFrame:
    """``asked`` once for each ``cell`` (a column that is added) whose bounds are within ``eps`` of the row's box, from ``low`` to ``high``.

    A row goes down the tree of cells (of width ``side``) and leaves a prefix as soon as its coordinates so far are out of reach.
    Few rows may become many, so they are dealt over all tasks first.
    """
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = asked.repartition(tasks, *asked.columns).withColumn("_gaps", F.lit(0.0))
    for k, level in enumerate(levels):
        a, z = F.col(f"{low}{k}"), F.col(f"{high}{k}")
        values = F.sequence(F.floor((a - eps) / side) - 1, F.floor((z + eps) / side) + 1)
        here = level.select(*[F.col(c).alias(f"_{c}") for c in level.columns])
        met = out.withColumn("_v", F.explode(values)).join(here, ["_v"] if k == 0 else ["_up", "_v"])
        gap = F.greatest(F.col("_lo") - z, a - F.col("_hi"), F.lit(0.0))
        met = met.withColumn("_gaps", F.col("_gaps") + gap * gap).filter(F.col("_gaps") <= eps * eps * (1 + SLACK))
        out = met.select(*asked.columns, "_gaps", F.col("_node").alias("_up"))
        if k % 3 == 2 and k + 1 < len(levels):  # plans stay short
            out = materialise(out, "asked")
    return out.select(*asked.columns, F.col("_up").alias("cell"))


def near_cells(cells: DataFrame, n: int) -> DataFrame:
    """(a, b): cells (columns cell and c, an array of ``n`` whole coordinates) whose boxes may be within the cell diagonal, once each, a <> b."""
    bounds = [x for i in range(n) for x in (F.col("c")[i].cast("double").alias(f"lo{i}"), (F.col("c")[i] + 1).cast("double").alias(f"hi{i}"))]
    boxes = cells.select("cell", "c", *bounds)
    met = cells_in_reach(boxes.withColumnRenamed("cell", "a").drop("c"), cell_tree(boxes, n), 1.0, math.sqrt(n))
    return met.filter("a < cell").select("a", F.col("cell").alias("b"))


def _boxes(members: DataFrame, n: int) -> DataFrame:
    """Bounding box, one point and size of every part of a cell, and where it is cut: in the middle of its widest side."""
    widths = F.array(*[F.struct((F.col(f"hi{i}") - F.col(f"lo{i}")).alias("w"), F.lit(i).alias("i"), ((F.col(f"hi{i}") + F.col(f"lo{i}")) / 2).alias("at")) for i in range(n)])
    point = F.min(F.struct(*[f"x{i}" for i in range(n)]))
    rows = members.groupBy("cell", "part").agg(F.count("*").alias("n"), point.alias("at"), *[
        f(f"x{i}").alias(f"{g}{i}") for i in range(n) for f, g in ((F.min, "lo"), (F.max, "hi"))])
    return materialise(rows.withColumn("cut", F.array_max(widths)), "boxes")


def _as_side(boxes: DataFrame, n: int, side: str, *kept: str) -> DataFrame:
    """Boxes with columns that end in the side that they stand for in a pair."""
    own = [F.col("at")[f"x{i}"].alias(f"at_{side}{i}") for i in range(n)] + [F.col(f"{g}{i}").alias(f"{g}_{side}{i}") for g in ("lo", "hi") for i in range(n)]
    return boxes.select(F.col("cell").alias(side), F.col("part").alias(f"part_{side}"), F.floor(F.col("part") / 2).alias(f"up_{side}"),
                        F.col("n").alias(f"n_{side}"), *own, *kept)


def _joined(n: int, eps: float) -> tuple[Column, Column]:
    """Of a pair of boxes (sides a and b): whether two of their points surely are within ``eps``, and whether any can be."""
    gap = [F.greatest(F.col(f"lo_b{i}") - F.col(f"hi_a{i}"), F.col(f"lo_a{i}") - F.col(f"hi_b{i}"), F.lit(0.0)) for i in range(n)]
    span = [F.greatest(F.col(f"hi_b{i}") - F.col(f"lo_a{i}"), F.col(f"hi_a{i}") - F.col(f"lo_b{i}")) for i in range(n)]
    near, far = _sum([g * g for g in gap]), _sum([s * s for s in span])
    return (far <= eps * eps * (1 - SLACK)) | (_distance2(n, "at_a", "at_b") <= eps * eps), near <= eps * eps * (1 + SLACK)


def axis_links(boxes: DataFrame, n: int, eps: float) -> DataFrame:
    """(a, b): cells (columns of ``_boxes``, and c) that differ in one coordinate only and surely hold two points within ``eps``.

    Not every link of such cells is found, but in a crowded space most are, from a number of candidates that follows the cells.
    """
    moved = F.array(*[F.array(*[F.col("c")[j] + (o if i == j else 0) for j in range(n)]) for i in range(n) for o in range(1, math.isqrt(n) + 2)])
    a = _as_side(boxes, n, "a", "c").withColumn("c", F.explode(moved.alias("m")))
    return a.join(_as_side(boxes, n, "b", "c"), "c").filter(_joined(n, eps)[0]).select("a", "b")


def crowded_links(points: DataFrame, pairs: DataFrame, n: int, eps: float, max_level: int = 60) -> DataFrame:
    """Pairs (a, b) of ``pairs`` whose cells hold two points (columns cell, x0, x1 ...) within ``eps``.

    ``pairs`` may name the groups (columns u, v) that its cells belong to: then these are linked, and pairs of linked groups are left out.
    """
    if "u" not in pairs.columns:
        pairs = pairs.withColumn("u", F.col("a")).withColumn("v", F.col("b"))
        return crowded_links(points, pairs, n, eps, max_level).withColumnsRenamed({"u": "a", "v": "b"})
    open_ = materialise(pairs.select("a", "b", "u", "v", F.lit(0).cast("bigint").alias("up_a"), F.lit(0).cast("bigint").alias("up_b")), "pairs")
    involved = open_.select(F.col("a").alias("cell")).union(open_.select("b")).distinct()
    members = salted_join(points, involved, ["cell"], "left_semi").select("cell", *[f"x{i}" for i in range(n)]).distinct()
    members = materialise(members.withColumn("part", F.lit(1).cast("bigint")), "members")
    budget, links = 10 * max(1_000, members.count()), None
    for level in range(max_level + 1):
        boxes = _boxes(members, n)
        a, b = _as_side(boxes, n, "a"), _as_side(boxes, n, "b")
        met, can = _joined(n, eps)
        joined = open_.join(a, ["a", "up_a"]).join(b, ["b", "up_b"]).filter(can)
        judged = materialise(joined.select("a", "b", "u", "v", "part_a", "part_b", "n_a", "n_b", met.alias("met")), "judged")
        sure = judged.filter("met").select("u", "v").distinct()
        links = sure if links is None else links.unionByName(sure)
        left = materialise(judged.join(sure, ["u", "v"], "left_anti"), "pairs")
        work = left.agg(F.coalesce(F.sum(F.col("n_a").cast("double") * F.col("n_b")), F.lit(0.0))).first()[0]
        if work <= budget or level == max_level:
            def side(s, p):
                return members.select(F.col("cell").alias(s), F.col("part").alias(f"part_{s}"), *[F.col(f"x{i}").alias(f"{p}{i}") for i in range(n)])

            exact = left.select("a", "b", "u", "v", "part_a", "part_b").join(side("a", "p"), ["a", "part_a"]).join(side("b", "x"), ["b", "part_b"])
            return links.unionByName(exact.filter(_distance2(n) <= eps * eps).select("u", "v").distinct())
        parts = left.select(F.col("a").alias("cell"), F.col("part_a").alias("part")).union(left.select("b", "part_b")).distinct()
        cuts = boxes.join(parts, ["cell", "part"], "left_semi").select("cell", "part", "cut")
        own = F.array(*[f"x{i}" for i in range(n)])[F.col("cut.i")]
        members = materialise(salted_join(members, cuts, ["cell", "part"]).select(
            "cell", *[f"x{i}" for i in range(n)], (F.col("part") * 2 + (own >= F.col("cut.at")).cast("bigint")).alias("part")), "members")
        open_ = left.select("a", "b", "u", "v", F.col("part_a").alias("up_a"), F.col("part_b").alias("up_b"))
    return links


def near_groups(dense: DataFrame, groups: DataFrame, levels: Sequence[DataFrame], side: float, eps: float) -> DataFrame:
    """(a, b, u, v), once each: crowded cells within reach of each other and their groups, u < v.

    Any pair has a cell outside the largest group, so these alone ask for the cells around them.
    """
    largest = groups.groupBy("group").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "group").limit(1)
    n, own = len(levels), groups.withColumnsRenamed({"cell": "own", "group": "own_group"})
    outside = own.join(largest.select(F.col("group").alias("own_group")), "own_group", "left_anti")
    asked = outside.join(dense.withColumnRenamed("cell", "own"), "own").select("own", "own_group", *[f"{g}{i}" for i in range(n) for g in ("lo", "hi")])
    met = cells_in_reach(asked, levels, side, eps).join(groups, "cell").filter(F.col("group") != F.col("own_group"))
    ends = [F.struct(F.col(g).alias("g"), F.col(c).alias("c")) for g, c in (("own_group", "own"), ("group", "cell"))]
    pairs = met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
    return pairs.select(F.col("a.c").alias("a"), F.col("b.c").alias("b"), F.col("a.g").alias("u"), F.col("b.g").alias("v"))


def density_clusters(df: DataFrame, columns: Sequence[str], eps: float, min_samples: int, key: str = "id") -> DataFrame:
    """(key, label) of every row of ``df``; noise is -1.

    Clusters are numbered by their smallest core key; a border point joins the lowest numbered cluster in reach. A row with a null
    or a coordinate that isn't a number is noise. ``key`` must be unique. Points of thin cells (fewer than ``min_samples``)
    are compared with the points of the cells in reach; crowded cells are joined to groups, and groups that are near by halving.
    """
    n, side = len(columns), eps / math.sqrt(len(columns)) * (1 - SLACK)
    xs = [f"x{i}" for i in range(n)]
    rows = df.select(F.col(key).alias("id"), *[F.col(c).cast("double").alias(x) for c, x in zip(columns, xs)])
    finite = F.lit(True)
    for x in xs:
        finite = finite & F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = materialise(rows, "rows")
    placed = rows.filter(finite).withColumn("c", F.array(*[F.floor(F.col(x) / side) for x in xs]))
    bounds = [f(x).alias(f"{g}{i}") for i, x in enumerate(xs) for f, g in ((F.min, "lo"), (F.max, "hi"))]
    cells = materialise(placed.groupBy("c").agg(F.count("*").alias("n"), F.min("id").alias("cell"), F.min(F.struct(*xs)).alias("at"), *bounds), "cells")
    points = materialise(salted_join(placed, cells.select("c", "cell", (F.col("n") >= min_samples).alias("crowded")), ["c"]).drop("c"), "points")
    levels = cell_tree(cells, n)
    hot = hot_keys(points, ["cell"])
    crowd, thin = points.filter("crowded"), points.filter("not crowded")
    asks = thin.select(F.col("id").alias("p_id"), *[F.col(x).alias(f"p{i}") for i, x in enumerate(xs)])
    asks = materialise(cells_in_reach(asks, levels, side, eps, "p", "p"), "asks")
    within = _distance2(n) <= eps * eps
    # thin point -> crowded cell: how many of its points are in reach; thin point -> thin point
    to_crowd = materialise(salted_join(crowd, asks, ["cell"], hot=hot, spread_by=["id"]).filter(within).groupBy("p_id", "cell").agg(F.count("*").alias("c")), "reach")
    to_thin = materialise(thin.join(asks, "cell").filter(within).select("p_id", F.col("id").alias("q_id")), "reach")
    counts = to_crowd.select("p_id", "c").union(to_thin.select("p_id", F.lit(1).cast("bigint"))).groupBy("p_id").agg(F.sum("c").alias("c"))
    cores = counts.filter(F.col("c") >= min_samples).select(F.col("p_id").alias("id"))
    core_thin = materialise(thin.select("id", "cell").join(cores, "id", "left_semi"), "cores")
    nodes = core_thin.groupBy("cell").agg(F.min("id").alias("node"))  # core points of one cell are one node
    core_of = materialise(core_thin.join(nodes, "cell").select("id", "node"), "cores")
    as_p, as_q = core_of.select(F.col("id").alias("p_id"), F.col("node").alias("a")), core_of.select(F.col("id").alias("q_id"), F.col("node").alias("b"))
    dense = materialise(cells.filter(F.col("n") >= min_samples).withColumn("part", F.lit(1).cast("bigint")), "boxes")
    groups = materialise(connected_components(dense.select(F.col("cell").alias("node")), axis_links(dense, n, eps)).select(
        F.col("node").alias("cell"), F.col("root").alias("group")), "groups")
    links = to_crowd.join(as_p, "p_id").join(groups, "cell").select("a", F.col("group").alias("b"))
    links = links.union(to_thin.join(as_p, "p_id").join(as_q, "q_id").select("a", "b"))
    links = links.union(crowded_links(crowd, near_groups(dense, groups, levels, side, eps), n, eps).select(F.col("u").alias("a"), F.col("v").alias("b")))
    every = groups.select(F.col("group").alias("node")).union(nodes.select("node"))
    roots = materialise(connected_components(every, links), "roots")
    numbers = with_position(roots.select("root").distinct(), ["root"], name="label")
    labels = roots.join(numbers, "root").select("node", "label")
    of_groups = groups.join(labels.withColumnRenamed("node", "group"), "group").select(F.col("cell").alias("node"), "label")
    labels = materialise(of_groups.union(labels.join(nodes, "node", "left_semi")), "labels")
    crowd_labels = salted_join(crowd.select("id", "cell"), labels.withColumnRenamed("node", "cell"), ["cell"], hot=hot, spread_by=["id"]).select("id", "label")
    core_labels = core_of.join(labels, "node").select("id", "label")
    border = to_crowd.join(labels.withColumnRenamed("node", "cell"), "cell").select("p_id", "label").union(
        to_thin.join(core_labels.withColumnRenamed("id", "q_id"), "q_id").select("p_id", "label")).groupBy(
        F.col("p_id").alias("id")).agg(F.min("label").alias("label")).join(core_of.select("id"), "id", "left_anti")
    found = crowd_labels.union(core_labels).union(border.select("id", "label"))
    return rows.select("id").join(found, "id", "left").select(
        F.col("id").alias(key), F.coalesce(F.col("label").cast("int"), F.lit(NOISE)).alias("label"))
