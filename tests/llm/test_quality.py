import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brightledger.llm import quality

SCHEMA = "doc_id bigint, text string, lang string, source string, kept string"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep, n < 50 or 100 * rep > 50 * n)


def corpus():
    r = random.Random(2)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(300)]
    rows = []
    for d in range(200):
        text = "\n".join(" ".join(r.choices(words, k=r.randint(5, 20))) for _ in range(r.randint(1, 12)))
        rows.append((d, text, r.choice(["en", "de", None]), r.choice(["a", "b", None])))
    rows += [(300, None, "en", "a"), (301, "", None, None), (302, " \n\t\n ", "en", "a"), (None, rows[0][1], "en", "a"), (303, "a b " * 3000, "en", "a"),
             (304, " ".join(r.choices(words[:40], k=4000)), "en", "a"), (305, "x\x0by\x0cz a\xa0b 🙂 é\u2028w", "en", "a"), (306, "p q r s p q r", "en", "a")]
    rows += [(400 + i, " ".join(w + "###" for w in r.choices(words, k=120)), "en", "a") for i in range(4)]
    rows += [(500 + i, "\n".join([" ".join(r.choices(words, k=9))] * 3 + [" ".join(r.choices(words, k=60))]), "en", "a") for i in range(4)]
    return rows + rows[:2]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash") for r in corpus()], SCHEMA).repartition(4)


@pytest.mark.parametrize("few", [0, 32])
def test_counts_equal_brute_force(docs, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW", few)
    got = sorted((tuple(r[c] for c in quality.RESULT[:-1]) for r in quality.judged(docs).collect()), key=str)
    assert got == sorted(((d, *base(t)) for d, t, _, _ in corpus()), key=str)


def test_verdicts(docs):
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(docs).collect()}
    assert not any(kept[d] for d in [*range(400, 404), *range(500, 504), 300, 301, 302])
    plain = [d for d in range(200) if not base(dict((r[0], r[1]) for r in corpus())[d])[-1]]
    assert sum(kept[d] for d in plain) >= 0.97 * len(plain)


def test_stage_keeps_rows_as_they_are(docs):
    verdict = quality.judged(docs).filter("kept").select("doc_id").collect()
    got = quality.passing(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted((r["doc_id"] for r in verdict), key=str)
    assert quality.passing(docs.limit(0)).isEmpty() and quality.judged(docs.limit(0)).isEmpty()


def test_sketches_merge(docs):
    rows = quality.metrics(quality.measured(docs))
    one, other = quality.sketches(rows.filter("doc_id % 2 = 0")), quality.sketches(rows.filter("doc_id % 2 = 1 or doc_id is null"))
    merged = one.unionByName(other).groupBy("lang", "source", "metric", "bucket").agg({"n": "sum"}).collect()
    assert sorted(map(str, (tuple(r) for r in merged))) == sorted(map(str, (tuple(r) for r in quality.sketches(rows).collect())))


def test_the_stage_measures_every_text_once(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    own = quality.metrics(quality.measured(docs.withColumn("doc_id", F.struct(*docs.columns))))
    once = own.select(F.inline(F.array(F.struct(*own.columns)))).filter("not base_failed")
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    # nothing but the verdict on generated rows stands in the only filter
    first, second, *rest = plan.splitlines()
    assert "NOT base_failed" in first and "Generate inline" in second and not any("Filter" in line for line in rest)
    kept = {r["doc_id"] for r in quality.judged(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in quality.passing(docs).collect()} == kept
