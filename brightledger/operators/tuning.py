"""Adaptive hyper-parameter search: trials in batches, proposed from the densities of good and other trials so far.

The search itself is a small loop over a trial table; what costs is fitting, and that is Spark's: a batch of settings is
cross-validated at once. Every finished batch is a file of the trial table, so a search that stops is taken up where it was.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIALS = "trial int, batch int, setting string, loss double"


@dataclass(frozen=True)
class Interval:
    """A number between ``low`` and ``high``, on a logarithmic scale if ``log``, whole if ``whole``."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def to_unit(self, value: float) -> float:
        low, high, v = (math.log(x) for x in (self.low, self.high, value)) if self.log else (self.low, self.high, value)
        return (v - low) / (high - low)

    def from_unit(self, unit: float) -> float:
        unit = min(1.0, max(0.0, unit))
        if self.log:
            value = math.exp(math.log(self.low) + unit * (math.log(self.high) - math.log(self.low)))
        else:
            value = self.low + unit * (self.high - self.low)
        return round(value) if self.whole else min(self.high, max(self.low, value))

    def draw(self, rnd: random.Random):
        return self.from_unit(rnd.random())


@dataclass(frozen=True)
class Choice:
    """One of some values."""

    values: tuple

    def draw(self, rnd: random.Random):
        return rnd.choice(self.values)


Space = Mapping[str, Interval | Choice]


class _Parzen:
    """Density of past values on the unit interval: a normal kernel around each, as wide as the gap to its neighbours, and a wide one."""

    def __init__(self, past: Sequence[float]):
        points = sorted([*past, 0.5])
        prior = points.index(0.5)
        ends = [0.0, *points, 1.0]
        least = 1.0 / min(100.0, 1.0 + len(points))
        self.centres = points
        self.widths = [1.0 if i == prior else min(1.0, max(least, ends[i + 1] - ends[i], ends[i + 2] - ends[i + 1])) for i in range(len(points))]
        self.masses = [_normal((1 - c) / w) - _normal(-c / w) for c, w in zip(self.centres, self.widths)]

    def draw(self, rnd: random.Random) -> float:
        i = rnd.randrange(len(self.centres))
        while True:
            x = rnd.gauss(self.centres[i], self.widths[i])
            if 0 <= x <= 1:
                return x

    def log(self, x: float) -> float:
        return math.log(sum(math.exp(-((x - c) / w) ** 2 / 2) / (w * m) for c, w, m in zip(self.centres, self.widths, self.masses)) / (len(self.centres) * math.sqrt(2 * math.pi)))


class _Counted:
    """Probability of each value of a choice, one count of each before any trial."""

    def __init__(self, values: tuple, past: Sequence):
        self.values, counts = values, [1 + sum(p == v for p in past) for v in values]
        self.shares = [c / sum(counts) for c in counts]

    def draw(self, rnd: random.Random):
        return rnd.choices(self.values, self.shares)[0]

    def log(self, x) -> float:
        return math.log(self.shares[self.values.index(x)])


def _normal(z: float) -> float:
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def propose(space: Space, trials: Sequence[tuple[dict, float]], n: int, seed: int = 42, startup: int = 10, good_share: float = 0.2,
            candidates: int = 24) -> list[dict]:
    """The next ``n`` settings after ``trials`` (setting, loss); a loss that isn't a number counts as the worst.

    The first ``startup`` are drawn evenly. Then, parameter by parameter, candidates are drawn from the density of the best
    ``good_share`` of the trials, and the one that is likeliest there against the density of all others is taken. Settings of a
    batch that aren't known yet count among the others, so a batch spreads. The same trials and seed give the same settings.
    """
    known = sorted(((s, x if x is not None and math.isfinite(x) else math.inf) for s, x in trials), key=lambda t: t[1])
    n_good = max(1, math.ceil(good_share * len(known))) if known else 0
    good, other = [s for s, _ in known[:n_good]], [s for s, _ in known[n_good:]]
    out = []
    for k in range(n):
        at = len(trials) + k
        rnd = random.Random(f"{seed}:{at}")
        if at < startup or not known:
            out.append({name: part.draw(rnd) for name, part in space.items()})
            continue
        setting = {}
        for name, part in space.items():
            if isinstance(part, Choice):
                well, ill = (_Counted(part.values, [s[name] for s in past]) for past in (good, other))
                drawn = [well.draw(rnd) for _ in range(candidates)]
                setting[name] = max(drawn, key=lambda x: well.log(x) - ill.log(x))
            else:
                well, ill = (_Parzen([part.to_unit(s[name]) for s in past]) for past in (good, other))
                drawn = [well.draw(rnd) for _ in range(candidates)]
                setting[name] = part.from_unit(max(drawn, key=lambda x: well.log(x) - ill.log(x)))
        other.append(setting)
        out.append(setting)
    return out


def stored_trials(spark: SparkSession, path: str) -> list[tuple[int, int, dict, float]]:
    """Trials under ``path``, in order; none where nothing is stored yet. There are as many as were asked for, a few dozen or hundred."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(TRIALS).parquet(path).collect()
    except AnalysisException:
        return []
    whole = {r["trial"]: r for r in rows}
    return [(r["trial"], r["batch"], json.loads(r["setting"]), r["loss"]) for _, r in sorted(whole.items())]


def adaptive_search(spark: SparkSession, space: Space, losses: Callable[[list[dict]], Sequence[float]], path: str, trials: int = 25,
                    batch: int = 5, seed: int = 42, startup: int = 10, good_share: float = 0.2, adaptive: bool = True) -> DataFrame:
    """(trial, batch, setting, loss, best_loss, best): the history of a search, whose trials are kept under ``path``.

    ``losses`` gets a batch of settings and gives their losses, lower being better. Trials that ``path`` holds already aren't
    run again. best_loss is the lowest loss so far, best marks the best trial (the first of several). Not ``adaptive``: an even
    draw for every trial, to compare with.
    """
    done = stored_trials(spark, path)
    while len(done) < trials:
        size = min(batch, trials - len(done))
        first = len(done)
        settings = propose(space, [(s, x) for _, _, s, x in done], size, seed, startup if adaptive else trials, good_share)
        number = done[-1][1] + 1 if done else 0
        found = [(first + i, number, s, float(x)) for i, (s, x) in enumerate(zip(settings, losses(settings), strict=True))]
        rows = [(t, b, json.dumps(s, sort_keys=True), x) for t, b, s, x in found]
        spark.createDataFrame(rows, TRIALS).coalesce(1).write.mode("append").parquet(path)
        done += found
    best, rows = math.inf, []
    lowest = min(done[:trials], key=lambda d: (d[3] if math.isfinite(d[3]) else math.inf, d[0]))[0]
    for t, b, s, x in done[:trials]:
        best = min(best, x) if math.isfinite(x) else best
        rows.append((t, b, json.dumps(s, sort_keys=True), x, best, t == lowest))
    return spark.createDataFrame(rows, f"{TRIALS}, best_loss double, best boolean")


def best_setting(history: DataFrame) -> dict:
    return json.loads(history.filter("best").first()["setting"])


def cross_validated_losses(train: DataFrame, estimator: Estimator, evaluator: Evaluator, folds: int = 3, parallelism: int = 4,
                           seed: int = 42) -> Callable[[list[dict]], list[float]]:
    """Losses of a batch of settings of ``estimator``: all of them fitted on every fold, several at once."""

    def losses(settings: list[dict]) -> list[float]:
        maps = [{estimator.getParam(n): v for n, v in s.items()} for s in settings]
        model = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds,
                               parallelism=parallelism, seed=seed).fit(train)
        return [-x if evaluator.isLargerBetter() else x for x in model.avgMetrics]

    return losses


def importance(history: DataFrame, space: Space) -> DataFrame:
    """(parameter, importance): how far a parameter's ranks follow those of the losses (absolute rank correlation; for choices, the
    share of the rank variance between its values), most important first."""
    rows = sorted(history.select("setting", "loss").collect(), key=lambda r: (r["loss"], r["setting"]))
    settings, n = [json.loads(r["setting"]) for r in rows], len(rows)
    out, mean = [], (n - 1) / 2
    spread = sum((i - mean) ** 2 for i in range(n))
    for name, part in space.items():
        values = [s[name] for s in settings]
        if isinstance(part, Choice):
            groups = [[i for i, v in enumerate(values) if v == x] for x in part.values]
            share = sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups if g) / spread if spread else 0.0
            out.append((name, math.sqrt(share)))
        else:
            order = sorted(range(n), key=lambda i: (values[i], i))
            rank = {j: i for i, j in enumerate(order)}
            out.append((name, abs(sum((i - mean) * (rank[i] - mean) for i in range(n))) / spread if spread else 0.0))
    return history.sparkSession.createDataFrame(out, "parameter string, importance double").orderBy(F.desc("importance"), "parameter")
