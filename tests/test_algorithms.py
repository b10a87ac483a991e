"""Iterative and geometric operators against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.functions import strings, tails
from brightledger.operators import arrays, clustering, components, graph, joins, recommend, retrieval


def iou(a, b):
    w = max(0, min(a[2], b[2]) - max(a[0], b[0]))
    h = max(0, min(a[3], b[3]) - max(a[1], b[1]))
    area = lambda c: (c[2] - c[0]) * (c[3] - c[1])
    return w * h / (area(a) + area(b) - w * h + 1e-6)


@pytest.fixture(scope="module")
def crowded():
    rnd = random.Random(3)

    def box():
        x, y = rnd.randrange(0, 300), rnd.randrange(0, 200)
        return x, y, x + rnd.randrange(1, 120), y + rnd.randrange(1, 90)

    truth = {f"t{i:03d}": box() for i in range(60)}
    guesses = {f"p{i:03d}": tuple(c + rnd.randrange(-6, 7) * (k < 2) for k, c in enumerate(truth[f"t{i % 60:03d}"])) for i in range(90)}
    guesses = {k: (min(v[0], v[2]), min(v[1], v[3]), max(v[0], v[2]), max(v[1], v[3])) for k, v in guesses.items()}
    return truth, guesses


def box_frames(spark, crowded):
    schema = "filename string, {} string, xmin int, ymin int, xmax int, ymax int"
    return [spark.createDataFrame([("one", k, *v) for k, v in side.items()], schema.format(name))
            for side, name in zip(crowded, ("box_id", "pred_id"))]


def test_overlaps_in_a_crowded_image(spark, crowded):
    truth, guesses = crowded
    want = {(t, p): iou(a, b) for (t, a), (p, b) in itertools.product(truth.items(), guesses.items()) if iou(a, b) > 0}
    rows = joins.overlapping_boxes(*box_frames(spark, crowded), cell=32).collect()
    assert len(rows) == len(want)
    assert all(r["iou"] == pytest.approx(want[r["box_id"], r["pred_id"]]) for r in rows)


@pytest.mark.parametrize("threshold", [0.3, 0.5])
def test_greedy_matching(spark, crowded, threshold):
    truth, guesses = crowded
    free, want = set(truth), {}
    for p in sorted(guesses):
        best = max(((iou(truth[t], guesses[p]), [-ord(c) for c in t], t) for t in free), default=(0, None, None))
        if best[0] >= threshold:
            want[p] = best[2]
            free.discard(best[2])
    pairs = joins.overlapping_boxes(*box_frames(spark, crowded))
    got = {r["pred_id"]: r["box_id"] for r in joins.greedy_matches(pairs, threshold=threshold).collect()}
    assert got == want


def test_touching_boxes_do_not_overlap(spark):
    a = spark.createDataFrame([("f", "a", 0, 0, 10, 10)], "filename string, box_id string, xmin int, ymin int, xmax int, ymax int")
    b = spark.createDataFrame([("f", "b", 10, 0, 20, 10)], "filename string, pred_id string, xmin int, ymin int, xmax int, ymax int")
    assert joins.overlapping_boxes(a, b).isEmpty()
    assert joins.best_overlap(a, b).first()["best_iou"] == 0.0
    assert joins.greedy_matches(joins.overlapping_boxes(a, b)).isEmpty()


def plain_density(points, eps, m):
    n = len(points)
    near = [[j for j in range(n) if (points[i][0] - points[j][0]) ** 2 + (points[i][1] - points[j][1]) ** 2 <= eps * eps] for i in range(n)]
    core = [len(x) >= m for x in near]
    label, c = [-1] * n, 0
    for i in range(n):
        if not core[i] or label[i] != -1:
            continue
        stack, label[i] = [i], c
        while stack:
            for j in near[stack.pop()]:
                if label[j] == -1:
                    label[j] = c
                    if core[j]:
                        stack.append(j)
        c += 1
    return label


@pytest.mark.parametrize("seed,eps,m", [(0, 0.3, 4), (1, 0.15, 5), (2, 0.5, 10)])
def test_density_clusters(spark, seed, eps, m):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(0, 6, (5, 2))
    pts = [tuple(rng.normal(centres[i % 5], 0.35)) for i in range(250)]
    pts += [tuple(rng.normal(centres[0], 0.01)) for _ in range(150)]  # a third of the points in one cell
    pts += [tuple(rng.uniform(-1, 7, 2)) for _ in range(50)]
    pts = [(float(x), float(y)) for x, y in pts]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id int, x double, y double")
    got = {r["id"]: r["label"] for r in clustering.density_clusters(df, eps, m).collect()}
    assert [got[i] for i in range(len(pts))] == plain_density(pts, eps, m)


def test_density_on_a_grid(spark):
    """Neighbours exactly at the radius count, and crowded neighbouring cells stay apart or join exactly."""
    pts = [(x * 1.0, y * 1.0) for x in range(6) for y in range(6)] + [(20.0, 0.0)] * 12 + [(21.0001, 0.0)] * 12 + [(30.0, 0.0)] * 12 + [(31.0, 0.0)] * 12
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id int, x double, y double")
    got = {r["id"]: r["label"] for r in clustering.density_clusters(df, 1.0, 4).collect()}
    assert [got[i] for i in range(len(pts))] == plain_density(pts, 1.0, 4)


def test_density_all_noise(spark):
    df = spark.createDataFrame([(i, i * 10.0, 0.0) for i in range(5)], "id int, x double, y double")
    assert {r["label"] for r in clustering.density_clusters(df, 1.0, 2).collect()} == {-1}
    assert clustering.cluster_counts(clustering.density_clusters(df, 1.0, 2)).first().asDict() == {"n_clusters": 0, "n_noise": 5}


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, k) for k in range(201, 260)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(70)]
    nodes = sorted({x for e in edges for x in e} | {999})
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    e = spark.createDataFrame(edges, "a int, b int")
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame([(n,) for n in nodes], "node int"), e).collect()}
    assert got == {n: find(n) for n in nodes}


def test_pagerank_converges(spark):
    rnd = random.Random(2)
    edges = {(0, k): 1 for k in range(1, 40)} | {(rnd.randrange(1, 60), rnd.randrange(0, 60)): rnd.randrange(1, 4) for _ in range(150)}
    edges = {(s, d): w for (s, d), w in edges.items() if s != d}
    nodes = sorted({x for e in edges for x in e})
    out = {n: sum(w for (s, _), w in edges.items() if s == n) for n in nodes}
    rank = {n: 1 / len(nodes) for n in nodes}
    for _ in range(200):
        dangling = sum(rank[n] for n in nodes if not out[n])
        new = {n: 0.15 / len(nodes) + 0.85 * dangling / len(nodes) for n in nodes}
        for (s, d), w in edges.items():
            new[d] += 0.85 * rank[s] * w / out[s]
        rank = new
    df = spark.createDataFrame([(s, d, w) for (s, d), w in edges.items()], "src int, dst int, weight int")
    got = {r["node"]: r["rank"] for r in graph.pagerank(df, rounds=60, tolerance=1e-9).collect()}
    assert sum(got.values()) == pytest.approx(1.0)
    assert all(got[n] == pytest.approx(rank[n], abs=1e-6) for n in nodes)


def test_duplicate_edges_last_weight_wins(spark):
    raw = spark.createDataFrame([(1, 2, 5, 0), (1, 2, 7, 1)], "src int, dst int, weight int, ord int")
    index = spark.createDataFrame([(1, 0), (2, 1)], "user_id int, user_idx int")
    assert graph.indexed_edges(raw, index, "ord").collect() == [(0, 1, 7)]


def test_recommender_beats_the_mean(spark):
    rng = np.random.default_rng(4)
    u, v = rng.normal(0, 1, (40, 2)), rng.normal(0, 1, (30, 2))
    rows = [(i, j, float(np.clip(3 + u[i] @ v[j] * 0.6, 0, 5))) for i in range(40) for j in range(30) if (i * 7 + j) % 3]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, label double")
    edges = spark.createDataFrame([(i, (i + 1) % 40) for i in range(40)], "src bigint, dst bigint")
    ranks = spark.createDataFrame([(i, 1 / 40) for i in range(40)], "node bigint, rank double")
    model = recommend.fit(recommend.prepare(ratings, edges, ranks), rank=4, iterations=8, reg=0.02)
    q = recommend.fit_quality(model, ratings).first()
    assert q["r2"] > 0.7
    unknown = spark.createDataFrame([(999, 1), (1, 999)], "user_id bigint, item_id bigint")
    assert all(0 <= r["prediction"] <= 5 for r in model.predict(unknown).collect())


@pytest.mark.parametrize("queries_each,items_each", [(2, 30), (100, 10_000)])
def test_nearest_in_blocks(spark, monkeypatch, queries_each, items_each):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", queries_each)
    monkeypatch.setattr(retrieval, "ITEM_BLOCK", items_each)
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(200, 5)), rng.normal(size=(5, 5))
    items = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id int, embedding array<double>").repartition(4)
    queries = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(q)], "query_id int, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in retrieval.nearest(items, queries, 3).collect()}
    for i in range(5):
        want = np.argsort(((x - q[i]) ** 2).sum(axis=1))[:3]
        assert [got[i, k] for k in (1, 2, 3)] == want.tolist()


def test_fusion(spark):
    a = spark.createDataFrame([("q", 1, 1), ("q", 2, 2)], "query_id string, id int, rank int")
    b = spark.createDataFrame([("q", 2, 1), ("q", 3, 2)], "query_id string, id int, rank int")
    assert [r["id"] for r in retrieval.fuse(a, b, 3).orderBy("rank").collect()] == [2, 1, 3]


def test_similarity_ratio(spark):
    rows = [("", "", 1.0), ("abc", "abc", 1.0), ("abc", "xyz", 0.0), ("kitten", "sitting", 8 / 13), (None, "a", None)]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    for r in df.withColumn("got", strings.indel_ratio("a", "b")).collect():
        assert r["got"] == (pytest.approx(r["want"]) if r["want"] is not None else None)


def test_tail_probabilities():
    assert 2 * tails.normal_upper(1.959964) == pytest.approx(0.05, abs=1e-6)
    for t, df, p in ((2.228139, 10, 0.05), (2.042272, 30, 0.05), (12.7062, 1, 0.05), (3.169273, 10, 0.01)):
        assert tails.t_two_sided(t, df) == pytest.approx(p, abs=1e-5)
    for f, d1, d2, p in ((4.964603, 1, 10, 0.05), (3.886, 2, 12, 0.05), (7.562, 1, 30, 0.01)):
        assert tails.f_upper(f, d1, d2) == pytest.approx(p, abs=1e-4)
    assert tails.t_two_sided(0.0, 5) == pytest.approx(1.0)
    assert math.isclose(tails.incomplete_beta(2, 3, 0.5), 0.6875)


def test_interval_pairs_boundaries(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "a", 300), (3, "a", 301), (4, "a", 301), (5, "b", 10)], "id int, k string, s bigint")
    df = df.select("id", "k", F.timestamp_seconds("s").alias("ts"))
    got = {(r["id_1"], r["id_2"], r["gap_seconds"]) for r in joins.pairs_within_seconds(df, "k", 300, carry=["id"]).collect()}
    assert got == {(1, 2, 300), (2, 3, 1), (2, 4, 1)}


@pytest.mark.parametrize("n,block", [(12, 1_000), (12, 5), (1_200, 100)])
def test_round_robin_of_any_size(spark, n, block):
    df = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("team"))
    pairs = joins.group_pairs(df, "g", "team", block=block)
    assert pairs.count() == n * (n - 1) // 2 == pairs.distinct().count()


def test_more_labels_than_columns(spark):
    df = spark.range(12_000).select(F.col("id"), F.array(F.col("id").cast("string"), F.lit("all")).alias("l"))
    labels = arrays.learn_labels(df.filter("id % 2 = 0"), "l")
    assert labels.count() == 6_001 and arrays.multi_hot_rows(df, "id", "l", labels).count() == 18_000
