import random

import numpy as np
import pytest

from brightledger.llm import toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    r = random.Random(7)
    terms = {"".join(r.choices("abc", k=r.randint(2, 8))): 1.0 for _ in range(40)}
    m = toxicity.Matcher(terms)
    for _ in range(3000):
        w = "".join(r.choices("abcd", k=r.randint(1, 9)))
        near = [(edits(w, t), t) for t in terms]
        near = [(e, t) for e, t in near if e == 0 or e == 1 and len(t) >= toxicity.FUZZY_LETTERS]
        want = min(near) if near else None
        assert m.match(w) == (want and (want[1], want[0])), w


def test_context():
    m = toxicity.Matcher({"stupid": 1.0, "moron": 1.0})
    abuse = toxicity.features("you are a stupid thing", m)[0]
    assert toxicity.features("he is a stup1d or stupidd thing", m)[0] == pytest.approx(toxicity.FUZZY_WEIGHT)
    assert toxicity.features('it was “stupid” then', m)[0] == pytest.approx(toxicity.QUOTED)
    assert toxicity.features("she said stupid then", m)[0] == pytest.approx(toxicity.REPORTED)
    assert abuse == pytest.approx(toxicity.ADDRESSED)
    assert toxicity.Matcher({"stupid": 1.0}, frozenset({"stupid"})).match("stup1d") is None
    assert toxicity.features("", m) == [0.0, 0.0, 0.0]


def test_each_misspelling_alone():
    m = toxicity.Matcher({"stupid": 1.0, "moron": 1.0, "idiot": 1.0, "scum": 1.0, "imbecilic": 1.0})
    for w in ("stup1d", "id1ot", "mor0n", "st*pid", "st*p*d", "idoit", "sc*m", "5tupid", "stupiid", "imbbecillic", "imebcilic", "STUP!D", "m@ron"):
        assert toxicity.features(f"he is a {w} thing", m)[0] == pytest.approx(toxicity.FUZZY_WEIGHT), w
    for w in ("skum", "smuc", "s**m", "sc9m", "ab1cd", "st1p2d3x", "idyllic", "m0use", "ratio"):
        assert toxicity.features(f"he is a {w} thing", m) == [0.0, 0.0, 0.0], w
    exact = toxicity.Matcher(dict(m.terms), frozenset(m.terms))
    assert not any(exact.near(w) for w in ("stup1d", "st*p*d", "idoit", "sc*m", "imbbecillic"))
    # words that a mark only joins stay words of their own
    assert toxicity.features("he!moron!it and a@stupid.org", m)[1:] == pytest.approx(toxicity.features("he moron it and a stupid org", m)[1:])


def test_two_edits_equal_edit_distance():
    r = random.Random(3)
    terms = {"".join(r.choices("abc", k=r.randint(9, 11))): 1.0 for _ in range(15)}
    m = toxicity.Matcher(terms, most=2)
    for t in sorted(terms) * 20:
        w = "".join(c for c in t if r.random() > 0.12) + r.choice(["", "", "a"])
        near = min((edits(w, t), t) for t in terms)
        assert m.match(w) == ((near[1], near[0]) if near[0] <= 2 else None), w


def ranked(y, s):
    order = np.argsort(np.argsort(s)) + 1
    return (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_held_out_accuracy(spark):
    """On texts that the fit never sees, at the scale that the given tables have enough labels."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.op4_toxicity(spark, folder)
    rows = got.filter("held_out").join(labels, "doc_id").select("toxic", "score", "predicted").collect()
    y, s, p = (np.array([r[i] for r in rows]) for i in range(3))
    # about one toxic label in ten of that table is on a text without any such word
    assert ranked(y, s + 1e-9 * np.random.default_rng(0).random(len(s))) > 0.92
    hit = (p * y).sum()
    assert hit / y.sum() > 0.85 and hit / p.sum() > 0.95
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_training_never_sees_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int")
    import zlib

    seen = {int(r["text"].split()[1]) for r in toxicity.training_rows(docs, labels).collect()}
    assert seen == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "x", 3.0), (3, "w " * 50000, 4.0), (3, "w", 4.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = toxicity.scored(docs, *toxicity.fit(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r["score"] < toxicity.THRESHOLD and r["predicted"] == 0 for r in rows)
    assert toxicity.scored(docs.limit(0), toxicity.Matcher({}), np.zeros(4)).isEmpty()


def plain_spans(text):
    """Quotations by their definition, mark by mark."""
    out, open_ = [], {}
    for i, c in enumerate(text):
        if c == "\n" and text[:i].rfind("\n") >= 0 and text[text[:i].rfind("\n"):i].strip() == "":
            open_ = {}
        family = next((f for f in ('"', "“”„", "«»", "‹›") if c in f), None)
        if family is None:
            continue
        left, right = text[max(0, i - 1):i], text[i + 1:i + 2]
        if family in open_ and left and not left.isspace() and not right.isalnum():
            out.append((open_.pop(family), i))
        elif right and not right.isspace() and not left.isalnum():
            open_[family] = i
    return out


def test_contexts_equal_brute_force():
    r = random.Random(11)
    terms = {"stupid": 2.0, "moron": 1.5, "scum": 1.0}
    m = toxicity.Matcher(terms)
    parts = ["stupid", "moron", "scum", "plain", "said", "you", '"', "“", "”", "„", "«", "»", " ", " ", " ", "\n", "\n \n", ".", "x"]
    for _ in range(2000):
        text = "".join(r.choices(parts, k=r.randint(1, 60)))
        places, best, n = m.words(text), {}, 0
        words = [w for _, _, w in places]
        for i, (start, end, w) in enumerate(places):
            hit = m.near(w)
            if hit is None:
                continue
            n += 1
            weight = toxicity.FUZZY_WEIGHT if hit[1] else 1.0
            if any(a < start and end <= b for a, b in plain_spans(text)):
                weight *= toxicity.QUOTED
            if any(x in toxicity.REPORTING for x in words[max(0, i - 4):i]):
                weight *= toxicity.REPORTED
            if any(x in toxicity.ADDRESS for x in words[max(0, i - 4):i] + words[i + 1:i + 5]):
                weight *= toxicity.ADDRESSED
            best[hit[0]] = max(best.get(hit[0], 0), weight)
        got = toxicity.features(text, m)
        assert got[0] == pytest.approx(sum(terms[t] * w for t, w in best.items())), text
        if best:
            assert got[1:] == pytest.approx([np.log1p(len(best)), min(10.0, 100 * n / len(words))])


def test_quotations_of_any_length_and_abuse_between_two():
    m = toxicity.Matcher({"stupid": 1.0})
    far = "some words before it " * 300
    for opening, closing in ('""', "“”", "„“", "«»", "»«", "‹›", "””"):
        assert toxicity.features(f"he {opening}{far}stupid {far}end{closing} then", m)[0] == pytest.approx(toxicity.QUOTED), opening
        assert toxicity.features(f"{opening}a{closing} you stupid man {opening}b{closing}", m)[0] == pytest.approx(toxicity.ADDRESSED), opening
    assert toxicity.features('a 5" pipe, stupid thing, 6" long', m)[0] == pytest.approx(1.0)
    assert toxicity.features('"left open stupid\n\nother" paragraph', m)[0] == pytest.approx(1.0)


def test_the_automaton_begins_anew(monkeypatch):
    r = random.Random(5)
    terms = {"".join(r.choices("abc", k=7)): 1.0 for _ in range(60)}
    words = ["".join(r.choices("abcd", k=r.randint(5, 9))) for _ in range(2000)]
    want = toxicity.Matcher(terms).of_text(words)
    monkeypatch.setattr(toxicity, "KEPT_PARTS", 50)
    monkeypatch.setattr(toxicity, "KEPT_LETTERS", 100)
    small = toxicity.Matcher(terms)
    got = {}
    for w in words:
        got |= small.of_text([w])
    assert got == want and small.parts < 2000
