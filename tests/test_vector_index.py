import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.operators import retrieval as rt
from brightledger.operators import vector_index as vi


@pytest.fixture(scope="module")
def items(spark):
    r = np.random.default_rng(4)
    centres = r.normal(0, 1, (60, 24))
    x = np.concatenate([c + r.normal(0, 0.35, (60, 24)) for c in centres] + [np.repeat(centres[:1], 40, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9002, [math.nan] * 24), (9003, [None] * 24), (9004, [math.inf] * 24)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


@pytest.fixture(scope="module")
def index(items):
    return vi.build(items, n_lists=32)


def queries_of(items):
    return items.filter("vec_id % 50 = 0 or vec_id > 9000").select(F.col("vec_id").alias("query_id"), "embedding")


def test_every_vector_is_indexed(items, index):
    rows = index.lists()
    assert rows.count() == rows.select("id").distinct().count() == vi.usable(items, "embedding").count()
    assert index.sizes().count() > 20


def test_recall_against_the_exact_search(items, index):
    asked = queries_of(items)
    usable = vi.usable(items, "embedding")
    truth = rt.nearest(usable, vi.usable(asked, "embedding"), 5)
    found = vi.search(index, asked, 5, probes=8)
    # distances decide: several vectors are equal
    a = {(r["query_id"], r["rank"]): r["distance"] for r in found.collect()}
    b = {(r["query_id"], r["rank"]): r["distance"] for r in truth.collect()}
    assert set(a) == set(b)
    assert sum(a[k] <= b[k] + 1e-9 for k in b) / len(b) >= 0.95
    assert all(a[k] >= b[k] - 1e-9 for k in b)
    c = vi.compared(index, asked, probes=8).first()
    assert c["of"] == usable.count() * vi.usable(asked, "embedding").count() and c["compared"] < 0.5 * c["of"]


def test_all_lists_give_the_exact_result(items, index):
    asked = vi.usable(queries_of(items), "embedding").filter("query_id >= 100")
    truth = rt.nearest(vi.usable(items, "embedding"), asked, 5)
    found = vi.search(index, asked, 5, probes=1000, keep=20)
    assert vi.recall(found, truth).first()["recall"] == 1.0


def test_only_probed_lists_are_read(items, index):
    one = vi.usable(queries_of(items), "embedding").limit(1)
    plan = vi.search(index, one, 3, probes=2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [list" in plan or "PartitionFilters: [isnotnull(list" in plan
    assert vi.search(index, one.filter("query_id < 0"), 3).collect() == []


def test_large_lists_are_cut(spark, items, monkeypatch):
    monkeypatch.setattr(vi, "PIECE", 20)
    monkeypatch.setattr(vi, "QUERY_BLOCK", 7)
    cut = vi.build(items, n_lists=4)
    assert cut.lists().groupBy("list").agg(F.max("piece").alias("p")).agg(F.min("p")).first()[0] > 5
    asked = vi.usable(queries_of(items), "embedding").filter("query_id >= 100")
    truth = rt.nearest(vi.usable(items, "embedding"), asked, 5)
    assert vi.recall(vi.search(cut, asked, 5, probes=4, keep=20), truth).first()["recall"] == 1.0
