import math
import re
from collections import Counter

import pytest

from brightledger.llm import licenses

SCHEMA = "doc_id bigint, path string, text string, license string"
BODY = "word " * 300
DOCS = [
    (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0.", ""), (2, "a/b/x.py", BODY, ""), (3, "a/b/c/y.py", BODY + "\nLicensed under CC BY-NC 4.0.", ""),
    (4, "a/b/c/d/z.py", BODY, ""), (5, "a/b/c/d/COPYING", "GNU General Public License, version 3\n", ""), (6, "q/none.py", BODY, ""),
    (7, "top.py", BODY, ""), (8, None, BODY, ""), (9, "a/b/n.py", None, ""), (10, "a/b/e.py", "", ""), (None, "a/b/x.py", "license\n   the license is mine", ""),
    (11, "a/bb/x.py", BODY + "\n Licensed under the Apache License, Version 2.0. \nThis work is licensed under the GNU General Public License, version 3.", ""),
    (12, "ab/x.py", BODY, ""), (2, "a/b/x.py", BODY, ""), (13, "m/LICENSE", "MIT License", ""), (14, "m/LICENSE2", "MIT License", ""), (15, "m/L3", "Licensed under CC BY-NC 4.0.", ""), (16, "m/k.py", BODY, ""),
]


def test_licences(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    got = licenses.scanned(docs).collect()
    assert len(got) == len(DOCS)
    by = {r["doc_id"]: (r["own_license"], r["license"], r["inherited_from"]) for r in got}
    assert by == {
        1: ("Apache-2.0", "Apache-2.0", None), 2: (None, "Apache-2.0", "a"), 3: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None), 4: (None, "GPL-3.0", "a/b/c/d"),
        5: ("GPL-3.0", "GPL-3.0", None), 6: (None, None, None), 7: (None, None, None), 8: (None, None, None), 9: (None, "Apache-2.0", "a"),
        10: (None, "Apache-2.0", "a"), None: (None, "Apache-2.0", "a"), 11: ("Apache-2.0", "Apache-2.0", None), 12: (None, None, None),
        13: ("MIT", "MIT", None), 14: ("MIT", "MIT", None), 15: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None), 16: (None, "MIT", "m")}


def test_scores_equal_brute_force(spark):
    lines = ["Licensed under the Apache License, Version 2.0.", "apache license", "my own licence", "Copyright 2020 X. All rights reserved.", "MIT", "MIT MIT license", "GPL version 3 license"]
    terms = {x: Counter(re.findall(licenses.TERM, x.lower())) for x in [*lines, *(t for _, t in licenses.TEMPLATES)]}
    df = Counter(t for x in [*lines, *(t for _, t in licenses.TEMPLATES)] for t in terms[x])
    n = len(lines) + len(licenses.TEMPLATES)
    w = {x: {t: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in ts.items()} for x, ts in terms.items()}
    w = {x: {t: v / math.sqrt(sum(u * u for u in ts.values())) for t, v in ts.items()} for x, ts in w.items()}
    want = {}
    for x in lines:
        best = min((-round(sum(v * w[t].get(k, 0) for k, v in w[x].items()), 9), name) for name, t in licenses.TEMPLATES)
        if -best[0] >= licenses.COSINE:
            want[x] = (best[1], -best[0])
    got = licenses.matched_lines(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert {r["line"]: (r["license"], pytest.approx(r["score"], abs=1e-8)) for r in got} == want


def test_full_texts_are_licence_files(spark):
    texts = licenses.full_texts()
    rows = [(i, f"{n}/t.txt", "Copyright (c) 2020 Somebody Else and others\n\n" + t, "") for i, (n, t) in enumerate(texts.items())]
    rows += [(100 + i, f"{n}/src/deep/x.c", BODY, "") for i, n in enumerate(texts)]
    mit = texts["MIT"]
    rows += [(200, "u/COPYING", BODY + "\nLicensed under CC BY-NC 4.0.", ""), (201, "u/a.c", BODY, ""), (202, "v/a.c", " ".join(f"word{i}" for i in range(300)) + "\n" + mit, ""), (203, "v/b.c", BODY, ""),
             (204, "w/L", mit, ""), (204, "w/L", mit, ""), (205, "w/b.c", BODY, ""), (206, "z/t", "the license of the software is a thing that you may use", ""), (207, "z/b.c", BODY, "")]
    got = {r["doc_id"]: (r["own_license"], r["license"], r["inherited_from"]) for r in licenses.scanned(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, n in enumerate(texts):
        assert got[i] == (n, n, None) and got[100 + i] == (None, n, n), n
    assert got[200][0] == "CC-BY-NC-4.0" and got[201] == (None, "CC-BY-NC-4.0", "u") and got[203] == (None, None, None)
    assert got[204] == ("MIT", "MIT", None) and got[205] == (None, "MIT", "w") and got[206] == got[207] == (None, None, None)


def test_text_scores_equal_brute_force(spark):
    texts = licenses.full_texts()
    idf, vectors = licenses.whole_terms(texts)
    docs = {n: t[:k] + " another thing" for n, t in texts.items() for k in [3000]} | {"none": "word the of"}
    terms = {n: set(re.findall(licenses.TERM, t.lower())) for n, t in docs.items()}
    want = {}
    for n, ts in terms.items():
        w = {t: idf.get(t, math.log(1 + len(texts)) + 1) for t in ts}
        norm = math.sqrt(sum(v * v for v in w.values()))
        best = min((-round(sum(v * vectors[m].get(t, 0) for t, v in w.items()) / norm, 9), m) for m in vectors)
        share = sum(t in idf for t in ts) / len(ts)
        assert share >= best[0] ** 2
        if -best[0] >= 0.5:
            want[n] = (best[1], pytest.approx(-best[0], abs=1e-8))
    units = spark.createDataFrame([(n, sorted(ts)) for n, ts in terms.items()], "unit string, terms array<string>")
    assert {r["unit"]: (r["license"], r["score"]) for r in licenses.matched_texts(units, idf, vectors, 0.5).collect()} == want and len(want) > 5


def test_empty_table(spark):
    assert licenses.scanned(spark.createDataFrame([], SCHEMA)).isEmpty()
