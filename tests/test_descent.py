import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.operators import descent
from brightledger.session import materialise


def loop(rows, bu, bi, fu, fi, mean, rate, reg):
    """The plain loop over ratings, in order."""
    for u, i, label in rows:
        pred = min(5.0, max(0.0, mean + bu[u] + bi[i] + float(np.dot(fu[u], fi[i]))))
        e, own, other = label - pred, fu[u].copy(), fi[i].copy()
        fu[u] = own + rate * (e * other - reg * own)
        fi[i] = other + rate * (e * own - reg * other)
        bu[u] += rate * (e - reg * bu[u])
        bi[i] += rate * (e - reg * bi[i])


def ratings_of(n=1500, users=60, items=40, seed=1):
    r, g = random.Random(seed), np.random.default_rng(seed)
    a, b = g.normal(0, 1, (users, 2)), g.normal(0, 1, (items, 2))
    pairs = {(r.randrange(users) if r.random() > 0.3 else 7, r.randrange(items)) for _ in range(n)}  # user 7 has very many
    return [(100 + u, 1000 + i, float(min(5, max(0, 2.5 + a[u] @ b[i] + g.normal(0, 0.1))))) for u, i in sorted(pairs)]


def test_rounds_equal_the_loop():
    g = np.random.default_rng(0)
    u, i, label = g.integers(0, 12, 400), g.integers(0, 9, 400), g.uniform(0, 5, 400)
    one = [np.zeros(12), np.zeros(9), g.normal(0, 0.1, (12, 4)), g.normal(0, 0.1, (9, 4))]
    two = [x.copy() for x in one]
    descent.descend(u, i, label, *one, 2.4, 0.05, 0.02)
    loop(zip(u, i, label), *two, 2.4, 0.05, 0.02)
    for x, y in zip(one, two):
        assert np.allclose(x, y, atol=1e-12)
    level = descent.levels(u, i)
    for n in range(1, level.max() + 1):
        assert len(set(u[level == n])) == len(set(i[level == n])) == (level == n).sum()


@pytest.mark.parametrize("blocks", [2, 5])
def test_equals_a_loop_over_the_same_blocks(spark, blocks):
    df = spark.createDataFrame(ratings_of(), "user_id bigint, item_id bigint, label double")
    dense = materialise(descent.dense_ratings(df), "dense")
    rows = descent.strata(dense, blocks, 42)
    state = descent.first_state(dense, 3, 42)
    start = {(r["kind"], r["id"]): (r["b"], np.array(r["f"])) for r in state.collect()}
    n = [1 + max(k for s, k in start if s == kind) for kind in (0, 1)]
    b = [np.array([start[kind, k][0] for k in range(n[kind])]) for kind in (0, 1)]
    f = [np.array([start[kind, k][1] for k in range(n[kind])]) for kind in (0, 1)]
    mean = df.agg(F.avg("label")).first()[0]
    every, rate = rows.collect(), 0.03
    for _ in range(2):
        for s in range(blocks):
            state = descent.train_stratum(state, rows, s, blocks, mean, rate, 0.02, 3)
            order = sorted((r for r in every if r["stratum"] == s), key=lambda r: (r["block"], r["place"]))
            loop([(r["u"], r["i"], r["label"]) for r in order], b[0], b[1], f[0], f[1], mean, rate, 0.02)
        rate *= 0.95
    got = state.collect()
    assert len(got) == sum(n)
    for r in got:
        assert r["b"] == pytest.approx(b[r["kind"]][r["id"]], abs=1e-12)
        assert np.allclose(r["f"], f[r["kind"]][r["id"]], atol=1e-12)


def test_error_falls_by_epoch(spark):
    df = spark.createDataFrame(ratings_of(), "user_id bigint, item_id bigint, label double")
    edges = spark.createDataFrame([(100 + k, 100 + (k + 1) % 60, 1.0) for k in range(60)], "src bigint, dst bigint, weight double")
    ranks = spark.createDataFrame([(100 + k, 1 / 60) for k in range(60)], "node bigint, rank double")
    model, history = descent.fit_by_epochs(df, edges, ranks, rank=3, epochs=4, rate=0.05, blocks=2)
    rows = history.orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == [1, 2, 3, 4]
    assert all(a["rmse"] > b["rmse"] for a, b in zip(rows, rows[1:])) and rows[-1]["r2"] > 0.3
    assert rows[1]["rate"] == pytest.approx(0.05 * 0.95)
    assert model.predict(df).filter("prediction < 0 or prediction > 5").isEmpty()


def test_packed_predictions_equal_the_model_and_one_state_is_kept(spark, monkeypatch, tmp_path):
    import os

    from brightledger import session

    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    df = spark.createDataFrame(ratings_of(n=400), "user_id bigint, item_id bigint, label double")
    model, history = descent.fit_by_epochs(df, rank=3, epochs=3, rate=0.05, blocks=3)
    left = [d.rsplit("-", 1)[0] for d in os.listdir(tmp_path)]
    # 27 strata and 3 epochs were trained and measured; the last epoch's state is what the model reads
    assert left.count("state") == 1 and not {"strata", "dense", "ratings", "rated"} & set(left)
    last = history.orderBy(F.desc("epoch")).first()
    errors = model.predict(df).select((F.col("prediction") - F.col("label")).alias("e")).agg(F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") ** 2)).alias("rmse")).first()
    assert last["mae"] == pytest.approx(errors["mae"], abs=1e-12) and last["rmse"] == pytest.approx(errors["rmse"], abs=1e-12)


def test_chunks_do_not_follow_the_size_of_batches(spark):
    dense = spark.range(900).select((F.col("id") % 31).cast("int").alias("u"), (F.col("id") % 29).cast("int").alias("i"), (F.col("id") % 5).alias("label"))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, found = spark.conf.get(key), []
    try:
        for n in ("10000", "17"):
            spark.conf.set(key, n)
            packed = descent.packed_strata(descent.strata(dense, 2, 1)).orderBy("stratum", "home", "chunk").collect()
            found.append(packed)
    finally:
        spark.conf.set(key, before)
    assert found[0] == found[1] and len(found[0]) == 4
