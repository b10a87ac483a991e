import json
import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from brightledger.operators import models as m
from brightledger.operators import tuning
from brightledger.operators.tuning import Choice, Interval
from brightledger.session import scratch_path

SPACE = {"rate": Interval(1e-5, 1.0, log=True), "drop": Interval(0.0, 1.0), "size": Interval(1, 64, whole=True), "kind": Choice(("a", "b", "c", "d"))}


def surface(s):
    """A bowl around rate 0.003, drop 0.3, size 20 of kind c."""
    return (math.log10(s["rate"] / 0.003) ** 2 + 8 * (s["drop"] - 0.3) ** 2 + ((s["size"] - 20) / 25) ** 2 + (0 if s["kind"] == "c" else 1.0))


def plain_search(trials, seed, adaptive):
    done = []
    while len(done) < trials:
        for s in tuning.propose(SPACE, done, 5, seed, 10 if adaptive else trials):
            done.append((s, surface(s)))
    return min(x for _, x in done)


def test_better_than_random_at_equal_trials():
    pairs = [(plain_search(60, seed, True), plain_search(60, seed, False)) for seed in range(20)]
    assert sum(a < b for a, b in pairs) >= 16
    assert sum(a for a, _ in pairs) < 0.4 * sum(b for _, b in pairs)


def test_proposals_lie_in_the_space_and_repeat():
    r = random.Random(1)
    done = [({n: p.draw(r) for n, p in SPACE.items()}, r.choice([r.random(), math.nan, math.inf])) for _ in range(40)]
    one = tuning.propose(SPACE, done, 30)
    assert one == tuning.propose(SPACE, done, 30)
    for s in one:
        assert 1e-5 <= s["rate"] <= 1 and 0 <= s["drop"] <= 1 and s["size"] in range(1, 65) and s["kind"] in "abcd"
    assert len({json.dumps(s) for s in one}) == 30


def test_densities_integrate_to_one():
    r = random.Random(3)
    for n in (0, 1, 2, 30):
        d = tuning._Parzen([r.random() ** 3 for _ in range(n)] + [0.0] * (n > 2))
        grid = [(i + 0.5) / 4000 for i in range(4000)]
        assert sum(math.exp(d.log(x)) for x in grid) / 4000 == pytest.approx(1, abs=2e-3)
    c = tuning._Counted(("x", "y"), ["x"] * 3)
    assert c.shares == [0.8, 0.2]


def test_a_stopped_search_goes_on(spark):
    path, seen = scratch_path(spark, "trials"), []

    def losses(settings):
        if len(seen) == 10:
            raise RuntimeError("stopped")
        seen.extend(settings)
        return [surface(s) for s in settings]

    with pytest.raises(RuntimeError):
        tuning.adaptive_search(spark, SPACE, losses, path, trials=20)
    done = []
    got = tuning.adaptive_search(spark, SPACE, lambda b: done.extend(b) or [surface(s) for s in b], path, trials=20)
    whole = tuning.adaptive_search(spark, SPACE, lambda b: [surface(s) for s in b], scratch_path(spark, "trials"), trials=20)
    assert len(done) == 10 and got.collect() == whole.collect()
    rows = got.orderBy("trial").collect()
    assert [r["trial"] for r in rows] == list(range(20)) and [r["batch"] for r in rows] == [i // 5 for i in range(20)]
    assert sum(r["best"] for r in rows) == 1
    best = math.inf
    for r in rows:
        best = min(best, r["loss"])
        assert r["best_loss"] == best
    assert tuning.best_setting(got) == json.loads(min(rows, key=lambda r: (r["loss"], r["trial"]))["setting"])


def test_importance(spark):
    history = tuning.adaptive_search(spark, {"x": Interval(0, 1), "y": Interval(0, 1), "k": Choice(("a", "b"))},
                                     lambda b: [s["x"] ** 2 + 0.01 * s["y"] for s in b], scratch_path(spark, "trials"), trials=40, adaptive=False)
    got = tuning.importance(history, {"x": Interval(0, 1), "y": Interval(0, 1), "k": Choice(("a", "b"))}).collect()
    assert got[0]["parameter"] == "x" and got[0]["importance"] > 0.95 and all(r["importance"] < 0.5 for r in got[1:])


def test_cross_validated(spark):
    r = random.Random(0)
    rows = [(float(i % 2), Vectors.dense([i % 2 + r.gauss(0, 0.3), r.gauss(0, 1)])) for i in range(200)]
    train = spark.createDataFrame(rows, ["label", "features"])
    losses = tuning.cross_validated_losses(train, LogisticRegression(maxIter=20), m.accuracy_evaluator("label"), 2)
    good, bad = losses([{"regParam": 0.001}, {"regParam": 1000.0}])
    assert good < -0.85 and bad > good
