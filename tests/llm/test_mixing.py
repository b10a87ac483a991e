import random
from collections import defaultdict
from hashlib import md5

import pytest

from brightledger.llm import mixing

WEIGHTS = {"domain": {"web": 3.0, "code": 0.5}, "lang": {"en": 4.0, "xx": 0.0}, "source": {"src0": 5.0}}


def domain(source):
    digits = "".join(c for c in source or "" if c.isdigit())
    n = int(digits or 0)
    return "code" if n % 5 == 4 else "books" if n % 10 >= 6 else "web"


def rows_of(corpus):
    return [(d, (domain(s), lang, s), len((t or "").split())) for d, t, lang, s in corpus]


def fill(children, total):
    """Budgets of siblings {name: (cap, weight)}: shares by weight, again and again for those that aren't full."""
    got, left = {}, dict(children)
    while left:
        rate = total / sum(w for _, w in left.values())
        full = [c for c, (cap, w) in left.items() if cap <= rate * w]
        if not full:
            return {**got, **{c: rate * w for c, (_, w) in left.items()}}
        for c in full:
            got[c] = left.pop(c)[0]
            total -= got[c]
    return got


def brute(corpus, share, epochs, seed=mixing.SEED):
    rows = rows_of(corpus)
    tokens = defaultdict(int)
    for _, leaf, n in rows:
        tokens[leaf] += n
    levels = ("domain", "lang", "source")
    weight = lambda k, v: WEIGHTS[levels[k]].get(v, 1.0)
    live = {leaf for leaf in tokens if all(weight(k, leaf[k]) > 0 for k in range(3))}
    known = {(): sum(tokens.values()) * share}
    for k in range(3):
        new = {}
        for parent, total in known.items():
            caps = defaultdict(int)
            for leaf in live:
                if leaf[:k] == parent:
                    caps[leaf[:k + 1]] += tokens[leaf] * epochs
            new |= fill({c: (cap, weight(k, c[k])) for c, cap in caps.items()}, min(total, sum(caps.values())))
        known = new
    out = []
    for leaf in live:
        budget = int(known[leaf] + 0.01)
        if not tokens[leaf]:
            continue
        whole, rest = divmod(budget, tokens[leaf])
        own = [(md5(f"{seed}:{whole}:{'' if d is None else d}".encode()).hexdigest(), d, n) for d, x, n in rows if x == leaf]
        out += [(d, *leaf, n, e) for _, d, n in own for e in range(whole)]
        places = defaultdict(int)
        for p, _, n in own:
            places[p] += n
        before = 0
        for p in sorted(places):
            if before < rest:
                out += [(d, *leaf, n, whole) for q, d, n in own if q == p]
            before += places[p]
    return sorted(out, key=str)


def corpus():
    r = random.Random(9)
    rows = [(i, "w " * r.randint(0, 60), r.choice(["en", "de", "xx", None]), f"src{r.choice([0, 0, 0, 1, 4, 7, 9, 13])}") for i in range(500)]
    return rows + [(900, None, "en", "src0"), (901, "", "en", None), (None, "a b c", "en", "odd"), rows[5], rows[5], (902, "v " * 20000, "de", "src7")]


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.9, 2), (2.0, 3), (50.0, 2)])
def test_equals_brute_force(spark, share, epochs):
    docs = spark.createDataFrame([(*r, 1.5, 3) for r in corpus()], "doc_id bigint, text string, lang string, source string, weight double, epoch int")
    got = mixing.mixed(docs, share, epochs, WEIGHTS).select("doc_id", *mixing.LEVELS, "n_tokens", "epoch").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(corpus(), share, epochs)


def test_slots_do_not_change_the_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_DIGITS", 1)
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string, source string")
    got = mixing.mixed(docs, 0.3, 1, WEIGHTS).select("doc_id", *mixing.LEVELS, "n_tokens", "epoch").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(corpus(), 0.3, 1)


def test_stage_keeps_columns_and_repeats_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = mixing.stage(spark, docs, folder)
    assert got.columns == docs.columns and got.count() == got.select("doc_id").distinct().count()
    words = "size(split(trim(text), '[ \\\\s]+'))"
    share = got.selectExpr(f"sum({words})").first()[0] / docs.selectExpr(f"sum({words})").first()[0]
    assert 0.58 < share < 0.85  # a leaf ends with a whole document, and leaves are small here
    assert mixing.stage(spark, docs.limit(0), folder).isEmpty() and mixing.mixed(docs.limit(0)).isEmpty()


def test_stage_meets_each_leafs_budget_of_one_epoch(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixing.with_tokens(docs)
    budget = {tuple(r[c] for c in mixing.LEVELS): (r["budget"], r["tokens"]) for r in mixing.budgets(rows, mixing.SHARE, mixing.WEIGHTS, 1).collect()}
    largest, taken = defaultdict(int), defaultdict(int)
    for r in rows.collect():
        largest[tuple(r[c] for c in mixing.LEVELS)] = max(largest[tuple(r[c] for c in mixing.LEVELS)], r["n_tokens"])
    for r in mixing.with_tokens(mixing.stage(spark, docs, folder)).collect():
        taken[tuple(r[c] for c in mixing.LEVELS)] += r["n_tokens"]
    for leaf, (most, tokens) in budget.items():
        assert most <= tokens and most <= taken[leaf] < most + max(1, largest[leaf]), leaf
