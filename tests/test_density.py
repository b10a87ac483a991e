import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.operators import density


def brute(points, eps, least):
    x = np.array([p[1:] for p in points])
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= least
    label, n = [-1] * len(points), 0
    for i in range(len(points)):  # points are in the order of their keys
        if core[i] and label[i] < 0:
            todo = [i]
            label[i] = n
            while todo:
                j = todo.pop()
                for k in np.flatnonzero(near[j] & core):
                    if label[k] < 0:
                        label[k] = n
                        todo.append(k)
            n += 1
    for i in range(len(points)):
        if not core[i]:
            label[i] = min((label[k] for k in np.flatnonzero(near[i] & core)), default=-1)
    return {p[0]: v for p, v in zip(points, label)}


def frame(spark, points):
    d = len(points[0]) - 1
    return spark.createDataFrame([(int(p[0]), *map(float, p[1:])) for p in points], "id bigint, " + ", ".join(f"f{i} double" for i in range(d))), [f"f{i}" for i in range(d)]


@pytest.mark.parametrize("d, eps, least", [(3, 0.5, 5), (7, 1.1, 6)])
def test_equals_brute_force(spark, d, eps, least):
    r = np.random.default_rng(d)
    x = [r.normal(c, 0.22, (120, d)) for c in r.uniform(-3, 3, (4, d))]
    x += [np.repeat(r.uniform(-3, 3, (1, d)), 400, axis=0) + r.normal(0, 0.004, (400, d))]  # one crowded cell
    x += [x[-1][:1] + np.linspace(0, 2.5, 40)[:, None] * np.eye(d)[0], r.uniform(-4, 4, (100, d)), x[0][:3], x[0][:3]]
    x = np.concatenate(x)
    points = [(7 * i % 100_003, *row) for i, row in enumerate(x.tolist())]
    points.sort()
    df, columns = frame(spark, points)
    got = {r["id"]: r["label"] for r in density.density_clusters(df, columns, eps, least).collect()}
    want = brute(points, eps, least)
    assert len(set(want.values())) > 3
    assert got == want


def test_neighbours_of_cells(spark):
    r = np.random.default_rng(9)
    for d in (2, 5):
        cells = {tuple(c) for c in r.integers(-4, 5, (150, d)).tolist()}
        rows = [(i, list(c)) for i, c in enumerate(sorted(cells))]
        got = {tuple(sorted(x)) for x in density.near_cells(spark.createDataFrame(rows, "cell bigint, c array<bigint>"), d).collect()}
        want = {(i, j) for i, a in rows for j, b in rows if i < j and sum(max(abs(x - y) - 1, 0) ** 2 for x, y in zip(a, b)) <= d}
        assert got == want


def test_crowded_cells_are_compared_by_halving(spark):
    r = np.random.default_rng(2)
    eps = 1.0
    a, b, c = (r.uniform(0, 0.5, (3000, 3)) + np.array(at) for at in ((0, 0, 0), (1.45, 0, 0), (0, 1.9, 0)))
    rows = [(k, *map(float, p)) for k, part in enumerate((a, b, c)) for p in part]
    pts = spark.createDataFrame(rows, "cell bigint, x0 double, x1 double, x2 double")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a bigint, b bigint")
    got = {tuple(x) for x in density.crowded_links(pts, pairs, 3, eps).select("a", "b").collect()}
    parts = (a, b, c)
    want = {(i, j) for i, j in ((0, 1), (0, 2), (1, 2)) if min(((p - parts[j]) ** 2).sum(axis=1).min() for p in parts[i]) <= eps * eps}
    assert got == want and want == {(0, 1)}


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, None), (3, math.nan, 0.0), (4, 0.1, 0.0), (5, math.inf, 0.0), (6, 0.0, 0.1)], "k bigint, u double, v double")
    got = {r["k"]: r["label"] for r in density.density_clusters(df, ["u", "v"], 0.3, 3, key="k").collect()}
    assert got == {1: 0, 2: -1, 3: -1, 4: 0, 5: -1, 6: 0}
    assert density.density_clusters(df.filter(F.lit(False)), ["u", "v"], 0.3, 3, key="k").collect() == []
