"""Licence scans: sparse TF-IDF cosine of header lines and whole documents to templates, then inheritance from the nearest directory above."""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import WORD, read
from brightledger.session import materialise

#: Least cosine of a match.
COSINE = 0.6
#: Least cosine of a whole document to a licence's full text.
TEXT_COSINE = 0.7
#: Licences whose full texts lie in ``license_texts``.
TEXTS = "Apache-2.0 BSD-2-Clause BSD-3-Clause CC0-1.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MIT MPL-2.0".split()
#: Names of licence files.
FILE_NAME = r"(?i)(?:^|/)(?:(?:un)?licen[cs]e|copying)[^/]*\z"
#: A document is a licence file too if its matched lines hold at least one in so many of its words.
FILE_SHARE = 20
CUE = r"(?i)licen[cs]e|copyright|spdx|all rights reserved|public domain"
TERM = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
#: How licences are named in headers, one template each.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style 3-clause license."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
]


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def weighted(units: DataFrame, frequencies: DataFrame, n_units: Column) -> DataFrame:
    """(unit, term, w): unit-length TF-IDF vectors of ``units`` (unit, text) as rows; a term known to no unit has the largest weight."""
    counts = units.select("unit", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("unit", "term").agg(F.count("*").alias("tf"))
    idf = F.log((1 + n_units) / (1 + F.coalesce(F.col("df"), F.lit(0)))) + 1
    raw = counts.join(frequencies, "term", "left").select("unit", "term", ((1 + F.log("tf")) * idf).alias("w"))
    norms = raw.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, "unit").select("unit", "term", (F.col("w") / F.col("norm")).alias("w"))


def matched_lines(lines: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """(line, license, score) of the distinct ``lines`` (column line) that match a template; ties go to the first name.

    The table of lines is distinct, so a line repeated in a third of all documents is compared once. Weights come from all
    distinct lines and the templates.
    """
    spark = lines.sparkSession
    known = spark.createDataFrame(templates, "unit string, text string")
    units = lines.select(F.concat(F.lit("="), "line").alias("unit"), F.col("line").alias("text"))
    both = materialise(units.unionByName(known), "licence-lines")
    df = both.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = F.lit(both.count())
    vectors = materialise(weighted(both, df, n), "licence-vectors")
    of_lines = vectors.filter(F.col("unit").startswith("="))
    of_templates = vectors.filter(~F.col("unit").startswith("=")).select(F.col("unit").alias("license"), "term", F.col("w").alias("tw"))
    dots = of_lines.join(of_templates, "term").groupBy("unit", "license").agg(F.round(F.sum(F.col("w") * F.col("tw")), 9).alias("score"))
    best = dots.filter(F.col("score") >= cosine).groupBy("unit").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license"))).alias("b"))
    return best.select(F.substring("unit", 2, 1 << 30).alias("line"), F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def full_texts() -> dict[str, str]:
    return {n: pkgutil.get_data(__package__, f"license_texts/{n}.txt").decode() for n in TEXTS}


def whole_terms(texts: dict[str, str]) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """(IDF of the terms of ``texts``, unit-length vector of each text). A term of no text has the largest weight, ``unknown``."""
    terms = {n: set(re.findall(TERM, t.lower())) for n, t in texts.items()}
    df = Counter(t for ts in terms.values() for t in ts)
    idf = {t: math.log((1 + len(texts)) / (1 + k)) + 1 for t, k in df.items()}
    norms = {n: math.sqrt(sum(idf[t] ** 2 for t in ts)) for n, ts in terms.items()}
    return idf, {n: {t: idf[t] / norms[n] for t in ts} for n, ts in terms.items()}


def whole_candidate(terms: Column, idf: dict[str, float], cosine: float) -> Column:
    """Whether distinct ``terms`` can reach the cosine: its square is at most the share of terms that any text has, as others weigh most."""
    return (F.size(terms) > 0) & (F.size(F.array_intersect(terms, F.lit(sorted(idf)))) >= cosine * cosine * F.size(terms))


def matched_texts(units: DataFrame, idf: dict[str, float], vectors: dict[str, dict[str, float]], cosine: float = TEXT_COSINE) -> DataFrame:
    """(unit, license, score) of the distinct documents ``units`` (unit, terms) that match a full text; ties go to the first name."""
    spark = units.sparkSession
    unknown = math.log(1 + len(vectors)) + 1
    weights = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    known = spark.createDataFrame([(n, t, w) for n, v in sorted(vectors.items()) for t, w in sorted(v.items())], "license string, term string, tw double")
    each = units.select("unit", F.explode("terms").alias("term"))
    each = each.join(F.broadcast(weights), "term", "left").withColumn("w", F.coalesce("idf", F.lit(unknown)))  # bounded by the texts
    norms = each.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = each.join(F.broadcast(known), "term").groupBy("unit", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scores = dots.join(norms, "unit").select("unit", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).filter(F.col("score") >= cosine)
    best = scores.groupBy("unit").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license"))).alias("b"))
    return best.select("unit", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def ancestors(directory: Column) -> Column:
    """A directory and all above it, as an array; the empty path is above all."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def inherited(files: DataFrame) -> DataFrame:
    """(directory, license, from_directory) for every directory of ``files`` (directory, license, is_file) that has one above or is one.

    A directory's licence is the one that most of its licence files declare, ties to the first name. Each distinct directory is
    joined to those above it by path, and the deepest that has a licence wins.
    """
    votes = files.filter("is_file and license is not null").groupBy("directory", "license").agg(F.count("*").alias("n"))
    declared = votes.groupBy("directory").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("license"))).alias("v")).select(
        F.col("directory").alias("above"), F.col("v.license").alias("license"))
    every = files.filter("directory is not null").select("directory").distinct().select("directory", F.explode(ancestors(F.col("directory"))).alias("above"))
    found = every.join(declared, "above").withColumn("depth", F.length("above"))
    return found.groupBy("directory").agg(F.max_by(F.struct("license", "above"), "depth").alias("f")).select(
        "directory", F.col("f.license").alias("license"), F.col("f.above").alias("from_directory"))


def scanned(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """(doc_id, path, own_license, score, license, inherited_from) for every row of ``docs`` (doc_id, path, text; others ignored).

    A document's own licence is that of the full text that its whole text matches, else its best matching line's; without one it has that of the nearest directory above that licence
    files declare; else none. A licence file matches a full text, or names a licence and is called so or says little else. All lines of the whole text that name a licence are headers. Null and empty texts have no own
    licence, a null path inherits nothing. Repeated rows come back as often.
    """
    lines = F.array_distinct(F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(CUE)), lambda x: F.trim(x)))
    rows = docs.select("doc_id", "path", F.when(F.instr("path", "/") > 0, F.regexp_extract("path", r"(?s)\A(.*)/[^/]*\z", 1)).otherwise(
        F.when(F.col("path").isNotNull(), "")).alias("directory"), lines.alias("lines"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).alias("n_words"), F.col("text").alias("_text"))
    idf, vectors = whole_terms(full_texts())
    rows = rows.withColumn("_terms", F.array_distinct(terms_of(F.coalesce(F.col("_text"), F.lit("")))))
    rows = rows.withColumn("_whole", whole_candidate(F.col("_terms"), idf, TEXT_COSINE))
    rows = rows.withColumn("_unit", F.when(F.col("_whole"), F.sha2("_text", 256))).withColumn("_terms", F.when(F.col("_whole"), F.col("_terms"))).drop("_text", "_whole")
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "licence-rows")
    each = rows.select("_row", F.explode("lines").alias("line"))
    matches = materialise(matched_lines(each.select("line").distinct(), templates, cosine), "licence-matches")
    hits = each.join(matches, "line").select("_row", "license", "score", F.regexp_count("line", F.lit(WORD)).alias("n"))
    own = hits.groupBy("_row").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license"))).alias("b"), F.sum("n").alias("n"))
    own = own.select("_row", F.col("b.license").alias("own_license"), (-F.col("b.s")).alias("score"), F.col("n").alias("_n"))
    candidates = rows.filter("_unit is not null")
    units = candidates.select(F.col("_unit").alias("unit"), F.col("_terms").alias("terms")).dropDuplicates(["unit"])
    texts = matched_texts(units, idf, vectors).select(F.col("unit").alias("_unit"), F.col("license").alias("_text_license"), F.col("score").alias("_text_score"))
    whole = candidates.select("_row", "_unit").join(texts, "_unit").drop("_unit")
    named = F.col("path").rlike(FILE_NAME) & F.col("own_license").isNotNull()
    files = rows.join(own, "_row", "left").join(whole, "_row", "left").select(
        "doc_id", "path", "directory", F.coalesce("_text_license", "own_license").alias("own_license"),
        F.when(F.col("_text_license").isNotNull(), F.col("_text_score")).otherwise(F.col("score")).alias("score"),
        (F.col("_text_license").isNotNull() | F.coalesce(named, F.lit(False)) | F.coalesce(F.col("_n") * FILE_SHARE >= F.col("n_words"), F.lit(False))).alias("is_file"))
    files = materialise(files, "licence-files")
    above = inherited(files.select("directory", F.col("own_license").alias("license"), "is_file")).select(
        F.col("directory").alias("_d"), F.col("license").alias("_license"), "from_directory")
    # rows that inherit nothing get keys that meet nothing and lie in no one partition
    key = F.coalesce(F.when(F.col("own_license").isNull(), F.col("directory")), F.concat(F.lit("\0"), F.xxhash64("doc_id", "path").cast("string")))
    out = files.withColumn("_k", key).join(above, F.col("_k") == F.col("_d"), "left")
    return out.select("doc_id", "path", "own_license", "score", F.coalesce("own_license", "_license").alias("license"),
                      F.col("from_directory").alias("inherited_from"))


#: Paths of the given documents, which have none: source, language and two levels of numbers.
PATH = "concat_ws('/', source, lang, cast(doc_id div 1000 as string), cast(doc_id div 100 as string), concat(cast(doc_id as string), '.txt'))"


def op8_licenses(spark, folder):
    return scanned(read(spark, folder, "documents").withColumn("path", F.expr(PATH)))


def _sql() -> str:
    values = ", ".join(f"('{n}', '{t}')" for n, t in TEMPLATES)
    return rf"""
WITH t0(unit, text) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, concat_ws('/', source, lang, (doc_id // 1000)::VARCHAR, (doc_id // 100)::VARCHAR, doc_id::VARCHAR || '.txt') AS path,
      concat_ws('/', source, lang, (doc_id // 1000)::VARCHAR, (doc_id // 100)::VARCHAR) AS directory FROM documents),
e AS (SELECT DISTINCT r, trim(line, ' ') AS line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{CUE}')),
b AS (SELECT DISTINCT '=' || line AS unit, line AS text FROM e UNION ALL SELECT * FROM t0),
w AS (SELECT unit, term, count(*) AS tf FROM (SELECT unit, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM b) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM w GROUP BY ALL),
v AS (SELECT unit, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM b)) / (1 + df)) + 1) AS w FROM w JOIN f USING (term)),
n AS (SELECT unit, term, w / sqrt(sum(w * w) OVER (PARTITION BY unit)) AS w FROM v),
s AS (SELECT a.unit, z.unit AS license, round(sum(a.w * z.w), 9) AS score FROM n a JOIN n z USING (term) WHERE starts_with(a.unit, '=') AND NOT starts_with(z.unit, '=') GROUP BY ALL),
m AS (SELECT substr(unit, 2) AS line, license, score FROM s WHERE score >= {COSINE} QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, license) = 1),
h AS (SELECT r, license, score, len(regexp_extract_all(line, '{WORD}')) AS n FROM e JOIN m USING (line)),
o AS (SELECT r, first(license ORDER BY score DESC, license) AS own_license, max(score) AS score, sum(n) AS n FROM h GROUP BY r),
x AS (SELECT d.*, own_license, score, coalesce(n * {FILE_SHARE} >= len(regexp_extract_all(text, '{WORD}')), false) AS is_file FROM d LEFT JOIN o USING (r)),
c AS (SELECT directory AS above, own_license AS license FROM x WHERE is_file GROUP BY directory, own_license QUALIFY row_number() OVER (PARTITION BY directory ORDER BY count(*) DESC, own_license) = 1),
i AS (SELECT directory, license, above FROM (SELECT DISTINCT directory FROM x) y JOIN c ON y.directory = above OR starts_with(y.directory, above || '/')
      QUALIFY row_number() OVER (PARTITION BY directory ORDER BY length(above) DESC) = 1)
SELECT doc_id, path, own_license, score, coalesce(own_license, license) AS license, CASE WHEN own_license IS NULL THEN above END AS inherited_from FROM x LEFT JOIN i USING (directory)"""


SQL = _sql()
