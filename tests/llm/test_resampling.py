import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brightledger.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, run=1):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(1, run + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, buckets=10_000, run=1, seed=2024, percent=10, min_words=20):
    def counts(texts):
        return Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t, run))

    s, t = counts(x for _, x in docs), counts(target)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)}
    rows = []
    for d, text in docs:
        f = grams(text, run)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in f)
        rows.append([d, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(order[:percent * len(order) // 100])}
    return sorted(((*r, rank.get(id(r))) for r in rows), key=str)


def corpus(n=300):
    r = random.Random(4)
    vocabulary = ["w%d" % i for i in range(900)] + ["Ünder", "a-b", "ÀÉ", "X_y", "3rd", "漢字", "don't", "a\x00b", "z z"]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.choice([0, 1, 19, 20, 80, 400])))) for i in range(n)]
    docs += [(9001, None), (9002, ""), (9003, "--- \n\t ..."), (None, docs[5][1] + " more words to be many " * 5), (9004, "same word " * 3000),
             (9005, "x" * 400_000), *[(7, docs[7][1])] * 3]
    return docs, [" ".join(r.choices(vocabulary[:200], k=60)) for _ in range(40)] + [None, ""]


def frames(spark, docs, target):
    return (spark.createDataFrame([(d, t, "c", 1) for d, t in docs], "doc_id bigint, text string, weight string, open int"),
            spark.createDataFrame([(t,) for t in target], "text string"))


@pytest.mark.parametrize("options", [{}, {"run": 3, "buckets": 101, "seed": 5, "percent": 37, "min_words": 1}])
def test_equals_brute_force(spark, options):
    docs, target = corpus()
    got = resampling.resampled(*frames(spark, docs, target), **options).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(docs, target, **options)


def test_planes_give_exact_sums():
    r = np.random.default_rng(2)
    gain = r.integers(-9000, 9000, 777)
    rows = np.sort(r.integers(0, 1300, 60_000))
    found = r.integers(0, 777, 60_000) ** 2 % 777
    want = np.bincount(rows, gain[found], 1300).astype(np.int64)
    assert (resampling.weights(rows, found, 1300, resampling.signed_planes(gain), 777) == want).all()
    one = np.zeros(100_000, np.int64)
    assert resampling.weights(one, one, 2, resampling.signed_planes(gain), 777).tolist() == [100_000 * gain[0], 0]


def test_sliced_batches_and_nulls():
    texts = pa.array(["Ab c", None, "d--E e", "é É"])
    rows, _, n = resampling.features(texts.slice(1))
    assert n.tolist() == [0, 3, 2] and rows.tolist() == [1, 1, 1, 2, 2]


def test_the_draw_leans_to_the_target(spark):
    r = random.Random(1)
    docs = [(i, " ".join(r.choices(["a%d" % k for k in range(50)] if i % 4 else ["b%d" % k for k in range(50)], k=30))) for i in range(800)]
    target = [" ".join("b%d" % k for k in range(50))]
    drawn = resampling.resampled(*frames(spark, docs, target)).filter("rank is not null").collect()
    assert len(drawn) == 80 and all(x["doc_id"] % 4 == 0 for x in drawn)
    assert sorted(x["rank"] for x in drawn) == list(range(1, 81))


def test_empty_tables(spark):
    docs, target = corpus(20)
    empty_docs, empty_target = frames(spark, [], [])
    assert resampling.resampled(empty_docs, frames(spark, docs, target)[1]).collect() == []
    got = resampling.resampled(frames(spark, docs, target)[0], empty_target).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(docs, [])
