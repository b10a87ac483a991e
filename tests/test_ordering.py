"""Positions, running sums, frames and quantiles against plain Python."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightledger.operators import ordering as o
from brightledger.operators import series, skew


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    # a third of all rows share one group and one value
    return [(i, "hot" if i % 3 == 0 else f"g{i % 7}", 5.0 if i % 3 == 0 else float(rng.integers(0, 40))) for i in range(3000)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, g string, v double")


@pytest.mark.parametrize("parts", [1, 7])
def test_position_in_group(frame, rows, parts):
    got = {r["id"]: (r["idx"], r["n"]) for r in o.with_position(frame.repartition(parts), ["v", "id"], ["g"], count_name="n").collect()}
    for g in {r[1] for r in rows}:
        members = sorted((r[2], r[0]) for r in rows if r[1] == g)
        assert [got[i] for _, i in members] == [(k, len(members)) for k in range(len(members))]


def test_position_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    got = {r["id"]: r["idx"] for r in o.with_position(df, ["id"], ["g"]).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_position_of_nothing(frame):
    assert o.with_position(frame.filter("id < 0"), ["id"]).count() == 0


def test_running_sums(frame, rows):
    got = {r["id"]: (r["s"], r["s_total"]) for r in o.with_running_sums(frame, {"s": "v"}, ["v", "id"], ["g"], totals_too=True).collect()}
    for g in {r[1] for r in rows}:
        members = sorted((r[2], r[0]) for r in rows if r[1] == g)
        total, run = sum(v for v, _ in members), 0.0
        for v, i in members:
            run += v
            assert got[i] == (run, total)


def test_exact_quantiles(frame, rows):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for r in o.exact_quantiles(frame, "v", probs, ["g"]).collect():
        values = [x[2] for x in rows if x[1] == r["g"]]
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p))


@pytest.mark.parametrize("block", [7, 10, 1000])
def test_blocks_equal_one_window(frame, rows, block):
    ordered = sorted(rows)
    got = {r["id"]: r["trailing_mean"] for r in series.trailing_row_mean(frame, ["id"], "v", 7, block_rows=block).collect()}
    for k, (i, _, _) in enumerate(ordered):
        want = None if k < 7 else float(np.mean([x[2] for x in ordered[k - 7:k]]))
        assert got[i] == (pytest.approx(want) if want is not None else None)
    lead = {r["id"]: r["change"] for r in series.lead_difference(frame, ["id"], "v", 5, block_rows=block).collect()}
    assert len(lead) == len(rows) - 5
    assert all(lead[ordered[k][0]] == ordered[k + 5][2] - ordered[k][2] for k in range(len(rows) - 5))


def test_lookback_within_series(frame):
    out = series.lookback_windows(frame, ["id"], ["v"], "v", 4, ["g"], block_rows=50)
    assert out.count() == 3000 - 4 * 8
    assert out.filter(F.size("window") != 4).isEmpty()


def test_frame_wider_than_block(frame):
    wide, plain = (series.trailing_row_mean(frame, ["id"], "v", 7, block_rows=n) for n in (3, 100_000))
    assert wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty()


def test_chronological_split(frame):
    n = {r["split"]: r["count"] for r in series.chronological_split(frame, ["id"]).groupBy("split").count().collect()}
    assert n == {"train": 2100, "validation": 450, "test": 450}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, frame, how):
    other = spark.createDataFrame([("hot", 1), ("g1", 2), ("g1", 3), ("g9", 4)], "g string, w int")
    hot = skew.hot_keys(frame, ["g"])
    assert hot
    plain = frame.join(other, "g", how)
    got = skew.salted_join(frame, other, ["g"], how, hot, ["id"])
    assert got.columns == plain.columns
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_hot_keys_found_among_many(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id"))
    hot = skew.hot_keys(df, ["k"])
    assert list(hot.values()) == [[df.filter("k = -1").select(F.xxhash64("k")).first()[0]]]
    assert list(hot) == [4]  # a third of the rows over 8 partitions fills three
    assert skew.hot_keys(df, ["id"]) == {}


@pytest.mark.parametrize("share", [0.005, 0.6])
def test_salted_join_with_a_map_column(spark, share):
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        big = spark.range(20_000).select(F.when(F.col("id") < 20_000 * share, -1).otherwise(F.col("id")).alias("k"), F.col("id"), F.create_map(F.lit("os"), F.lit("x")).alias("m"))
        assert sum(map(len, skew.hot_keys(big, ["k"]).values())) == 1
        other = spark.createDataFrame([(-1, "hot"), (19_999, "one")], "k bigint, w string")
        assert skew.salted_join(big, other, ["k"]).count() == int(20_000 * share) + 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_selected_quantiles_equal_numpy(spark):
    n, draw = 30_000, np.random.default_rng(3)
    data = {"flat": draw.random(n), "tied": draw.integers(0, 4, n).astype(float), "wide": np.exp(draw.normal(0, 40, n)),
            "hot": np.where(draw.random(n) < 0.4, 7.0, draw.normal(7, 1e-9, n)), "same": np.full(n, 2.5)}
    frame = spark.createDataFrame(pd.DataFrame(data)).repartition(7).withColumns({
        "holes": F.when(F.col("flat") < 0.3, F.col("wide")), "none": F.lit(None).cast("double"),
        "nan": F.when(F.col("flat") < 0.001, F.lit(float("nan"))).otherwise(F.col("flat"))})
    probs = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p999": 0.999, "top": 1.0}
    got = {r["column"]: r for r in o.selected_quantiles(frame, frame.columns, probs).collect()}
    assert set(got) == set(frame.columns) - {"none"}
    data["holes"] = data["wide"][data["flat"] < 0.3]
    for c, values in data.items():
        for name, p in probs.items():
            assert got[c][name] == pytest.approx(np.quantile(values, p), rel=1e-12), (c, name)
    assert got["nan"]["mid"] == pytest.approx(np.quantile(np.where(data["flat"] < 0.001, np.inf, data["flat"]), 0.5))
    few = frame.limit(3).persist()
    want = np.quantile([r["flat"] for r in few.collect()], 0.5)
    assert o.selected_quantiles(few, ["flat"], {"mid": 0.5}).first()["mid"] == pytest.approx(want)
    assert o.selected_quantiles(frame.limit(0), ["flat"], {"mid": 0.5}).isEmpty()


def test_a_missed_rank_is_ranked_in_full(spark, monkeypatch):
    frame = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(o.F, "percentile_approx", lambda *a: F.array(*[F.lit(1.0 + i % 2) for i in range(len(a[1]))]))
    assert o.selected_quantiles(frame, ["v"], {"mid": 0.5}).first()["mid"] == 499.5


def test_selection_refines_and_never_ranks_in_full(spark, monkeypatch):
    frame = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"), (F.col("id") % 3).cast("double").alias("w"))
    frame = frame.withColumn("edge", F.when(F.col("v") > 0, 7.0).otherwise(F.col("v")))  # half of the rows are one value
    monkeypatch.setattr(o, "exact_quantiles", None)
    probs = {"q1": 0.25, "mid": 0.5, "q3": 0.75}
    got = {r["column"]: r for r in o.selected_quantiles(frame, frame.columns, probs, accuracy=100).collect()}
    data = frame.toPandas()
    for c in data:
        for n, p in probs.items():
            assert got[c][n] == pytest.approx(np.quantile(data[c], p), rel=1e-12)
