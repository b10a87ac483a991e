import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from brightledger.llm import languages

SYLLABLES = {"aa": ["ka", "to", "mi", "ре"], "bb": ["schl", "ung", "ei", "ö"], "cc": ["ção", "nh", "ou", "ka"], "dd": ["漢", "字", "語", "文"]}


def text(r, lang, n):
    return r.choice([" ", ", ", "\n"]).join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


def corpus(n=400):
    r = random.Random(6)
    rows = [(i, text(r, lang, r.choice([1, 2, 20, 300])), lang) for i in range(n) for lang in [r.choice("aabbccdd"[:6])] for lang in [lang * 2]]
    return [(d, t if d % 50 else None, g if d % 7 else None) for d, t, g in rows]


SCHEMA = "doc_id bigint, text string, lang string, score string, gram int, language int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2) for r in rows], SCHEMA)


def slow_grams(t, lengths):
    """n-grams as texts, edges as one space, by a plain reading of each word."""
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", t or ""):
        w = f" {''.join(c.lower() if len(c.lower()) == 1 else c for c in word)} "
        for n in lengths:
            for i in range(len(w) - n + 1):
                out[w[i:i + n]] += 1
    return out


@pytest.mark.parametrize("lengths", [(2,), (3,), (3, 4), (1, 5)])
def test_grams_equal_plain_ones(lengths):
    r = random.Random(1)
    texts = [None, "", "a", "Ab cD", "12 34", "x1y", *(text(r, k, 9) + "Ünd ßtraße" for k in SYLLABLES), "漢字" * 40_000 + " Ä" * 9]
    lengths = tuple(n for n in lengths if n > 1)
    got = [Counter() for _ in texts]
    for row, h in languages.grams(texts, lengths):
        for i, x in zip(row.tolist(), h.tolist()):
            got[i][x] += 1
    names = {}
    for counted, t in zip(got, texts):
        want = slow_grams(t, lengths)
        assert sorted(counted.values()) == sorted(want.values())
        assert counted.total() == want.total()
        for g, n in want.items():  # one hash a gram over all texts
            found = {x for x, y in counted.items() if y == n}
            names[g] = names.get(g, found) & found
            assert names[g]


def test_equals_brute_force(spark):
    rows = corpus()
    labelled = [(t, g) for d, t, g in rows if g and t and d % 3]
    known = languages.learned(spark.createDataFrame([(g, t) for t, g in labelled], "lang string, text string"), n_slots=1 << 16)
    order = sorted(Counter(g for _, g in labelled).items(), key=lambda x: (-x[1], x[0]))
    assert known.languages == [g for g, _ in order]
    sets, share = {}, {}
    for g, n in order:
        df = Counter(x for t, k in labelled if k == g for x in slow_grams(t, languages.LENGTHS))
        share[g] = {x: c / n for x, c in df.items() if c >= 3 and c / n >= languages.LEAST_SHARE}
    for g in share:
        sets[g] = {x for x, s in share[g].items() if s >= languages.BESIDE * max(o.get(x, 0) for o in share.values())}
    rows += [(9001, "漢字 語", None), (9002, "!! 12", None), (9003, "Qqqq xxxx", None), (None, rows[8][1], None), rows[9], rows[9]]
    got = languages.identified(frame(spark, rows), known).collect()
    assert len(got) == len(rows)
    texts = {d: t for d, t, _ in rows}
    for x in got:
        grams = slow_grams(texts[x["doc_id"]], languages.LENGTHS)
        found = {g: sum(n for w, n in grams.items() if w in sets[g]) for g in sets}
        if not grams:
            assert (x["lang_pred"], x["score"]) == ("und", 0)
        elif max(found.values()) > 5:  # the filter adds a few by chance, and the correction takes about as many
            assert abs(x["score"] - found[x["lang_pred"]] / sum(found.values())) < 0.1
            assert found[x["lang_pred"]] > max(found.values()) - 2


def test_no_language_is_missed_and_chance_is_corrected():
    """A filter never misses a language; the corrected counts of a crowded one stay near the true ones."""
    r = np.random.default_rng(0)
    known = languages.Filter(["a", "b", *(f"x{i}" for i in range(70))], 1 << 12, 2)
    texts = ["".join(map(chr, r.integers(lo, lo + 20, size))) for lo, size in ((97, 6), (0x3B1, 3000)) for _ in range(200)]
    masks = np.zeros_like(known.masks)
    for i, t in enumerate(texts[:200]):
        for _, h in languages.grams([t]):
            for s in languages.slots(h, 1 << 12, 2):
                masks[s, 0] |= np.uint64(1 << i % 2)
                masks[s, 1] |= np.uint64(1 << 5)
    slot, word = np.nonzero(masks)
    known.fill(slot, word, masks[slot, word].view(np.int64))
    assert known.by_chance[0] > 0.01
    hits, every = known.counts(texts)
    assert np.allclose(hits[:200, 69], every[:200])  # bit 5 of the second word
    assert 0.05 < known.by_chance[69]  # other letters: all hits are by chance
    assert hits[200:, 69].sum() / every[200:].sum() < 0.01


def test_held_out_accuracy(spark, folder):
    from brightledger.llm.queries import QUERIES

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op11_languages"](spark, folder).collect()
    assert len(got) == len(docs)
    held = [x for x in got if x["held_out"]]
    assert {x["doc_id"] for x in held} == {d for d in docs if zlib.crc32(str(d).encode()) % 3 == 1}
    right = [x["lang_pred"] == docs[x["doc_id"]]["lang"] for x in held]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= x["score"] <= 1 for x in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "lang string, text string")
    known = languages.learned(none)
    assert known.languages == []
    got = languages.identified(frame(spark, [(1, "some text", "aa"), (2, None, None)]), known).collect()
    assert [(x["lang_pred"], x["score"]) for x in got] == [("und", 0.0), ("und", 0.0)]
    assert languages.identified(frame(spark, []), known).collect() == []
    few = languages.learned(spark.createDataFrame([("aa", None), ("aa", ""), ("aa", "12")], "lang string, text string"))
    got = languages.identified(frame(spark, [(1, "word", None), (2, "1", None)]), few).collect()
    assert [(x["lang_pred"], x["score"]) for x in got] == [("aa", 0.0), ("und", 0.0)]
