"""What density clustering writes for crowded spaces, and groups of cells that touch at corners only."""

import numpy as np
from pyspark.sql import functions as F
from test_density import brute, frame

from brightledger.operators import density


def labels(df, columns, eps, least):
    return {r["id"]: r["label"] for r in density.density_clusters(df, columns, eps, least).collect()}


def test_crowded_cells_of_one_group_make_no_pairs(spark, monkeypatch):
    rows, write = {}, density.materialise

    def counted(df, label):
        out = write(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(density, "materialise", counted)
    x = np.stack(np.meshgrid(*[np.arange(0, 4, 0.1)] * 2), axis=-1).reshape(-1, 2)  # 1600 points, at least 9 in each of 144 cells
    df, columns = frame(spark, [(i, *p) for i, p in enumerate(x.tolist())])
    assert set(labels(df.filter("f0 < 3.85 and f1 < 3.85"), columns, 0.5, 4).values()) == {0}
    assert rows["boxes"] > 100 and max(rows.get(k, 0) for k in ("neighbours", "pairs", "asks")) == 0


def test_groups_that_touch_at_corners_equal_brute_force(spark):
    r = np.random.default_rng(4)
    eps, least, side = 1.0, 5, 1 / np.sqrt(2)
    corner = np.array([[side * k + 0.02 * s, side * k + 0.02 * s] for k in (1, 2) for s in (-1, 1)])  # cells (0,0), (1,1) and (2,2) meet at corners
    far = np.array([[side * 6 + 0.1, side * 6 + 0.1]])
    x = np.concatenate([c + r.normal(0, 0.004, (30, 2)) for c in [*corner, *far, far[0] + [1.3, 1.3], far[0] + [1.3, -1.3]]] + [r.uniform(-2, 7, (60, 2))])
    points = [(i, *p) for i, p in enumerate(x.tolist())]
    df, columns = frame(spark, points)
    want = brute(points, eps, least)
    assert len(set(want.values())) > 2
    assert labels(df, columns, eps, least) == want


def test_cells_in_reach_are_those_whose_bounds_are_near(spark):
    r = np.random.default_rng(6)
    side, eps, n = 0.5, 1.0, 3
    x, asked = r.uniform(-2, 2, (80, n)), r.uniform(-2.5, 2.5, (40, n))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(x.tolist())], "cell bigint, x0 double, x1 double, x2 double")
    cells = df.groupBy(F.array(*[F.floor(F.col(f"x{i}") / side) for i in range(n)]).alias("c")).agg(
        F.min("cell").alias("cell"), *[f(f"x{i}").alias(f"{g}{i}") for i in range(n) for f, g in ((F.min, "lo"), (F.max, "hi"))]).localCheckpoint()
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(asked.tolist())], "id bigint, p0 double, p1 double, p2 double")
    found = density.cells_in_reach(points, density.cell_tree(cells, n), side, eps, "p", "p").select("id", "cell").collect()
    bounds = {c["cell"]: (np.array([c[f"lo{i}"] for i in range(n)]), np.array([c[f"hi{i}"] for i in range(n)])) for c in cells.collect()}
    got = [tuple(f) for f in found]
    must = {(i, c) for i, p in enumerate(asked) for c, (lo, hi) in bounds.items() if (np.maximum(np.maximum(lo - p, p - hi), 0) ** 2).sum() <= eps * eps}
    assert len(got) == len(set(got)) and must <= set(got)
    assert len(got) < 1.5 * len(must)  # bounds of a prefix are a little wider than a cell's own
