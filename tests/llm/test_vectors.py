import numpy as np
import pytest

from brightledger.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links int"


def brute(rows, cosine=0.98):
    links = {i: set() for i in range(len(rows))}
    ok = [v is not None and len(v) and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    for i, (_, v, lab) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if ok[i] and ok[j] and rows[j][2] == lab and len(v) == len(w):
                a, b = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in links[todo.pop()] if k not in seen and not seen.add(k)]
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return out


def planted(n=400, size=16):
    r = np.random.default_rng(4)
    rows = []
    for i in range(n):
        v = r.standard_normal(size)
        label = int(r.integers(0, 3))
        rows.append((i, v, label))
        for k in range(int(r.choice([0, 0, 1, 4]))):
            rows.append((1000 * (k + 1) + i, v + r.standard_normal(size) * r.choice([0, 0.01, 0.03]), label))
    rows = [(d, [float(np.float32(x)) for x in v], lab) for d, v, lab in rows]
    rows += [(9000, None, 1), (9001, [], 1), (9002, [0.0] * size, 1), (9003, [float("nan")] * size, 1), (9004, [None] + [1.0] * (size - 1), 1),
             (9005, rows[0][1], None), (9006, rows[0][1][:8], rows[0][2]), (None, rows[3][1], rows[3][2]), (9007, rows[3][1], rows[3][2]), (9007, rows[3][1], rows[3][2])]
    return rows


@pytest.mark.parametrize("leaf,piece", [(16, 2048), (64, 24)])
def test_equals_brute_force(spark, leaf, piece):
    rows = planted()
    table = spark.createDataFrame([(d, v, lab, 7) for d, v, lab in rows], SCHEMA)
    got = [tuple(r) for r in vectors.near_duplicates(table, leaf=leaf, piece=piece).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_recall_on_the_given_table(spark, folder):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = vectors.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"), leaf=16).collect()
    want = {r[0]: r[1] for r in brute(rows)}
    assert sum(r["n_links"] for r in got) >= 0.98 * sum(want.values())
    assert all(r["n_links"] <= want[r["vec_id"]] for r in got)


def test_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).isEmpty()
