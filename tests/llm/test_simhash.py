import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brightledger.llm import simhash

SCHEMA = "doc_id bigint, text string, fp string"


def slow_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\x0b\x0c\r":
        words = words.replace(gap, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, bits=4):
    fps = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus():
    r = random.Random(5)
    words = ["w%d" % i for i in range(400)] + ["Ünder", "ÀB", "x y"]
    rows = []
    for d in range(60):
        text = r.choices(words, k=r.choice([1, 3, 4, 30, 200]))
        rows.append((d, " ".join(text)))
        for c in range(r.choice([0, 0, 3])):
            near = list(text)
            near[r.randrange(len(near))] = "changed"
            rows.append((1000 + 10 * d + c, "\n".join(near)))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (None, ""), (None, "alone here no other"), (5003, rows[7][1]), (5003, rows[7][1])]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "clash") for d, t in corpus()], SCHEMA)


def test_equals_brute_force(docs):
    got = simhash.simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(corpus())


def test_crowded_buckets_are_compared_in_pieces(spark):
    r = np.random.default_rng(3)
    base = np.int64(0x1234_5678_9ABC_DEF0)
    fps = {int(base ^ (np.int64(1) << np.int64(a)) ^ (np.int64(1) << np.int64(b))) for a, b in r.integers(0, 40, (300, 2))}
    fps |= {int(x) for x in r.integers(-2**62, 2**62, 200)}
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp bigint"), limit=16)
    a, b = simhash.forest(np.array(sorted(fps)).view(np.uint64), 4)
    from brightledger.llm.components import connected_components

    def classes(rows):
        out = {}
        for node, root in rows:
            out.setdefault(root, set()).add(node)
        return sorted(map(sorted, out.values()))

    order = np.array(sorted(fps))
    want = connected_components(spark.createDataFrame([(int(order[i]), int(order[j])) for i, j in zip(a, b)], "a bigint, b bigint"))
    assert classes(connected_components(links).collect()) == classes(want.collect())


def test_one_of_each(docs):
    rows = brute(corpus())
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [r["doc_id"] for r in got.collect()]
    assert sorted(kept, key=str) == sorted({c for _, _, c in rows}, key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_groups(empty).isEmpty() and simhash.one_of_each(empty).isEmpty()


def test_masks_catch_every_close_pair():
    masks = [m & (1 << 64) - 1 for m in simhash.block_masks()]
    r = random.Random(1)
    for _ in range(500):
        x = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not x & m for m in masks)


def test_one_of_each_with_any_column_names(spark):
    names = ["_fp", "_id", "_rows", "_kept", "row", "fp", "_own", "a.b"]
    rows = [(1, "a b c d e f g", 1), (1, "other words are here now", 2), (2, "a b c d e f g", 3), (3, "h i j k l m n o p", 4), (3, "h i j k l m n o p", 4), (None, None, 5)]
    df = spark.createDataFrame([(d, t, *[k] * len(names)) for d, t, k in rows], "doc_id bigint, text string, " + ", ".join(f"`{c}` int" for c in names))
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["_fp"]) for r in out.collect()), key=str)
    assert [d for d, _ in got] == [1, 3, None] and got[1:] == [(3, 4), (None, 5)]
