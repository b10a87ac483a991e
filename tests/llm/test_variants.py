import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from brightledger.llm import variants


def counted(docs):
    n = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def neighbours(n):
    return {w: [x for x in n if one_apart(w, x)] for w in n}


def brute(docs):
    n = counted(docs)
    near, form = neighbours(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    rows = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(rows, key=str)


def corpus():
    r = random.Random(8)
    parts = ["an", "er", "tion", "ré", "ñe", "sch", "aa", "ab", "x"]
    words = ["".join(r.choices(parts, k=r.randint(3, 6))) for _ in range(150)]
    docs = []
    for d in range(400):
        text = [words[min(int(r.expovariate(0.05)), 149)] for _ in range(40)]
        for i in range(3):
            w = text[i]
            k = r.randrange(len(w))
            text[i] = r.choice([w[:k] + w[k + 1:], w[:k] + r.choice("aeé") + w[k:], w[:k] + "ö" + w[k + 1:], w.upper(), w[::-1]])
        docs.append((d, r.choice([" ", "-", "1", "漢", "\n"]).join(text)))
    docs += [(900, None), (901, ""), (902, "12 !? 漢字"), (None, docs[3][1]), (3, docs[3][1]), (903, "b" * 50_000 + " " + "b" * 49_999 + " tail " + "b" * 50_000),
             (904, "b" * 50_000 + " " + "b" * 49_999), (905, "thandle " * 2000 + "thandel " * 20 + "thandl " * 150)]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(d, t, 1, "w") for d, t in docs], "doc_id bigint, text string, n int, word string")


def test_equals_brute_force(spark):
    docs = corpus()
    got = variants.spelling_variants(frame(spark, docs)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(docs)


@pytest.mark.parametrize("held_bytes", [1, 300])
def test_crowded_buckets_give_the_same(spark, held_bytes):
    r = random.Random(3)
    n = {"".join(r.sample("abcdefgh", 8)): r.randint(2, 90) for _ in range(700)}
    n |= {w[:k] + r.choice("axé") + w[k + r.randint(0, 1):]: r.randint(2, 9) for w in list(n)[:300] for k in [r.randrange(8)]}
    long = "".join(r.choices("abcdefghij", k=1500))
    n |= {long: 5, long[:700] + long[701:]: 50, long[:10] + "é" + long[11:]: 7, long + "a": 3, long[:999]: 4, long[:1000]: 8, long[:1001]: 6}
    got = {x["word"]: (x["n_near"], x["near"], x["near_n"]) for x in variants.near_words(
        spark.createDataFrame(list(n.items()), "word string, n bigint"), held_bytes).collect()}
    want = {}
    for w, near in neighbours(n).items():
        if near:
            best = min(near, key=lambda x: (-n[x], x))
            want[w] = (len(near), best, n[best])
    assert got == want


@pytest.mark.parametrize("first, second", [(1, 3), (1, 6), (2, 2), (2, 4), (3, 1)])
def test_one_edit_shares_a_signature(first, second):
    r = random.Random(first * 10 + second)
    a, b = [], []
    for _ in range(3000):
        w = "".join(r.choices("abcdeé", k=r.randint(1, 12)))
        k = r.randrange(len(w))
        a.append(w)
        b.append(r.choice([w[:k] + w[k + 1:], w[:k] + "z" + w[k:], w[:k] + "c" + w[k + 1:]]))
    x, y = variants.signatures(a, 2, first, second), variants.signatures(b, 2, first, second)
    assert (x == y).any(axis=1).all()
    far = variants.signatures(["".join(r.choices("abcdefghijklmnop", k=14)) for _ in range(2)], 2, first, second)
    assert not (far[0] == far[1]).all()


def test_first_common_choice():
    r = random.Random(2)
    for _ in range(300):
        b = "".join(r.choices("abcd", k=9))
        k = r.randrange(9)
        a = r.choice([b[:k] + b[k + 1:], b[:k] + "x" + b[k + 1:]])
        s = variants.signatures([a, b])
        w = variants.Letters([a, b])
        place = variants._edit_place(a, b)
        here = variants._first_choice(w, np.array([0]), np.array([1]), np.array([place]))
        assert here.tolist() == [int((s[0] == s[1]).argmax())]


def test_chains_of_forms(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("v", "w5"), ("u", "t")]
    got = dict(variants.roots(spark.createDataFrame(links, "word string, form string")).collect())
    assert got == {**{f"w{i}": "w11" for i in range(11)}, "v": "w11", "u": "t"}


def test_empty_tables(spark):
    assert variants.spelling_variants(frame(spark, [])).collect() == []
    assert variants.spelling_variants(frame(spark, [(1, None), (2, "short words only")])).collect() == []
