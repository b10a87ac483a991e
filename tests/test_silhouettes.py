"""Silhouettes in plain distance against their definition."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from brightledger.operators import clustering as cl


def defined(x, labels, i):
    d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
    own = labels == labels[i]
    if own.sum() == 1:
        return 0.0
    a = d[own].sum() / (own.sum() - 1)
    b = min(d[labels == c].mean() for c in set(labels) - {labels[i]})
    return (b - a) / max(a, b) if max(a, b) else 0.0


@pytest.mark.parametrize("sample", [10_000, 40])
def test_equal_the_definition(spark, sample, monkeypatch):
    monkeypatch.setattr(cl, "SAMPLE_BLOCK", 64)
    draw = np.random.default_rng(4)
    n = 400
    x = np.r_[draw.normal(0, 1, (n // 2, 5)), draw.normal(4, 1, (n // 2 - 50, 5)), np.full((50, 5), 9.0)]  # copies as well
    one, two = np.arange(n) % 3, (np.arange(n) >= n // 2).astype(int)
    two[7] = 9  # alone in its cluster
    rows = [(i, x[i].tolist(), int(one[i]), int(two[i])) for i in range(n)] + [(n, None, 0, 0)]
    frame = spark.createDataFrame(rows, "id int, vector array<double>, one int, two int").repartition(5)
    got = cl.silhouettes(frame, ["one", "two"], sample=sample).collect()
    assert len(got) == 2 * min(sample, n)
    for r in got:
        labels = one if r["labelling"] == "one" else two
        assert r["silhouette"] == pytest.approx(defined(x, labels, r["id"]), abs=1e-6), r


def test_unlabelled_rows_and_bounds(spark, monkeypatch):
    rows = [(1, [0.0], 0), (2, [1.0], 0), (3, [9.0], 1), (4, [100.0], None)]
    frame = spark.createDataFrame(rows, "id int, vector array<double>, label int")
    got = {r["id"]: r["silhouette"] for r in cl.silhouettes(frame, ["label"]).collect()}
    assert got == {1: pytest.approx(8 / 9), 2: pytest.approx(7 / 8), 3: 0.0}
    monkeypatch.setattr(cl, "SAMPLE_NUMBERS", 3)
    with pytest.raises(ValueError):
        cl.silhouettes(frame, ["label"])


def test_best_number_of_clusters(spark):
    draw = np.random.default_rng(5)
    x = np.concatenate([draw.normal(10 * c, 1, (60, 3)) for c in range(3)])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>").withColumn("features", array_to_vector("v"))
    found = {r["k"]: r["silhouette"] for r in cl.plain_silhouette_by_k(frame, range(2, 6)).collect()}
    assert set(found) == {2, 3, 4, 5} and max(found, key=found.get) == 3
