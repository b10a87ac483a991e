"""Quality rules with thresholds that follow each language and source.

Metrics are whole numbers, so the sketch (counts in buckets of bounded relative width) merges by addition in any order and
gives the same thresholds in every run and in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightledger.llm.common import GAP, WORD, named, read
from brightledger.session import materialise

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Metrics per thousand, with the least spread (quartile distance) that a threshold assumes.
SPREADS = {"word_length": 500, "symbols": 25, "dup_lines": 75, "repeats": 75, "capitals": 75, "shouts": 60}
#: Lines added to a text's own for the share of repeated ones: one line found twice says little in a text of three.
FEW_LINES = 5
#: A document goes when a metric lies more than so many spreads above the upper quartile.
REACH = 4
#: A group's quartiles count as its documents to this many of its language.
PRIOR_DOCS = 50
#: Significant bits of a bucket: bounds are right to one part in 64.
BITS = 7
#: Up to so many repeated windows are looked up in a list; with more, positions are found by sorting.
FEW = 32


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for null and blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once for a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``words``, all occurrences counted.

    Windows are compared by 64-bit hash. Most texts end at the first test: all windows differ.
    """
    last = F.size(words) - 3

    def windows(w):
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(starts):
        return F.size(F.array_distinct(F.flatten(F.array(starts, F.transform(starts, lambda i: i + 1), F.transform(starts, lambda i: i + 2)))))

    def twice(ordered):
        return F.array_distinct(F.filter(ordered, lambda h, i: (i > 0) & (F.get(ordered, i - 1) == h)))

    def by_list(g, again):
        return F.filter(F.transform(g, lambda h, i: F.when(F.array_contains(again, h), i)), lambda i: i.isNotNull())

    def by_order(g):
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(placed, lambda p: F.transform(F.filter(p, lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"]))
                                                             | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))

    def count(g):
        again = _let(F.sort_array(g), twice)
        some = _let(again, lambda a: covered(F.when(F.size(a) <= FEW, by_list(g, a)).otherwise(by_order(g))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(some)

    return F.when(last < 1, 0).otherwise(_let(words, lambda w: _let(windows(w), count))).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts) of every row. A null text has no words; n_lines counts lines with a word."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    letters = F.length(F.regexp_replace(text, r"[^\p{Lu}]", ""))
    rows = docs.select("doc_id", "lang", "source", words_of(F.col("text")).alias("words"), lines.alias("lines"),
                       F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), letters.cast("long").alias("n_capitals"),
                       (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_shouts"))
    rows = rows.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"), "n_capitals", "n_shouts")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return rows.withColumn("base_failed", failed)


def _per_thousand(part: str, whole: str, more: int = 0) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"1000 * {part} div ({whole} + {more})")).otherwise(F.lit(0)).cast("long")


def metrics(rows: DataFrame) -> DataFrame:
    """Add ``metrics``: name to whole number."""
    each = {"word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines", FEW_LINES),
            "repeats": ("n_repeat_words", "n_words"), "capitals": ("n_capitals", "word_chars"), "shouts": ("n_shouts", "n_words")}
    return rows.withColumns({f"m_{k}": _per_thousand(*v) for k, v in each.items()})


def bucket(value: Column) -> Column:
    """Lower bound of the value's bucket: its leading ``BITS`` bits."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): a mergeable quantile sketch of every metric of every language and source.

    Rows that fail the base rules take no part. Counts are combined map-side; a group holds some hundred buckets at most.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), bucket(F.col(f"m_{k}")).alias("bucket")) for k in SPREADS])
    return rows.filter("not base_failed").select("lang", "source", F.explode(pairs).alias("p")).groupBy(
        "lang", "source", F.col("p.metric").alias("metric"), F.col("p.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, metric, docs, q1, q3): bucket bounds at a quarter and three quarters of the documents, from merged sketches."""
    merged = sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "metric")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumn("upto", upto).withColumn("docs", F.sum("n").over(group))
    return ranked.groupBy(*by, "metric").agg(
        F.max("docs").alias("docs"), F.min(F.when(F.col("upto") * 4 >= F.col("docs"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs") * 3, F.col("bucket"))).alias("q3"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, one column per metric): what a document of the group may reach.

    Quartiles of a small group lean on those of its language. Null languages and sources are groups of their own.
    """
    own = quartiles(sketch, ["lang", "source"])
    wide = quartiles(sketch, ["lang"]).select(F.col("lang").alias("_l"), F.col("metric").alias("_m"), F.col("q1").alias("_q1"), F.col("q3").alias("_q3"))
    both = own.join(wide, own["lang"].eqNullSafe(wide["_l"]) & (own["metric"] == wide["_m"]))
    n = F.col("docs")

    def leant(a, b):
        return (F.col(a) * n + F.col(b) * PRIOR_DOCS) / (n + PRIOR_DOCS)

    spread = F.lit(None)
    for k, least in SPREADS.items():
        spread = F.when(F.col("metric") == k, least).otherwise(spread)
    spread = F.greatest(leant("q3", "_q3") - leant("q1", "_q1"), spread.cast("double"))
    limit = leant("q3", "_q3") + spread * REACH
    return both.withColumn("limit", limit).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == k, F.col("limit"))).alias(f"t_{k}") for k in SPREADS])


def judged(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang, source; others are ignored) with its counts, base_failed and kept.

    Counts are written once and read for the sketches and for the verdict. Empty and null texts fail the base rules;
    a group without a document that passes them has no thresholds and needs none.
    """
    rows = materialise(metrics(measured(docs)), "quality")
    limits = thresholds(sketches(rows)).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(limits, rows["lang"].eqNullSafe(limits["_lang"]) & rows["source"].eqNullSafe(limits["_source"]), "left")
    over = F.lit(False)
    for k in SPREADS:
        over = over | F.coalesce(F.col(f"m_{k}") > F.col(f"t_{k}"), F.lit(False))
    return joined.withColumn("kept", ~(F.col("base_failed") | over))


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Every text is measured once: rows that pass the base rules are written with their measures, which give the thresholds and
    then the verdict. Nulls, empty and very long texts and groups without thresholds as in ``judged``; rows repeated stay repeated.
    """
    own = metrics(measured(docs.withColumn("doc_id", F.struct(*named(docs)))))
    # a generated row: the filter isn't moved below it, where it would measure again
    once = own.select(F.inline(F.array(F.struct(*own.columns))))
    rows = materialise(once.filter("not base_failed"), "quality")
    limits = materialise(thresholds(sketches(rows)).withColumnsRenamed({"lang": "_lang", "source": "_source"}), "thresholds")
    joined = rows.join(limits, rows["lang"].eqNullSafe(limits["_lang"]) & rows["source"].eqNullSafe(limits["_source"]), "left")
    bad = F.lit(False)
    for k in SPREADS:
        bad = bad | F.coalesce(F.col(f"m_{k}") > F.col(f"t_{k}"), F.lit(False))
    return joined.filter(~bad).select("doc_id.*")


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op3_quality(spark, folder):
    return judged(read(spark, folder, "documents")).select(*RESULT)


def stage(spark, docs, folder):
    """The documents that pass; nulls, empty and very long texts and repeated rows as in ``passing``."""
    return passing(docs)


def _sql() -> str:
    spreads = "CASE metric " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SPREADS.items()) + " END"
    arms = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS metric, m_{k} AS v FROM m WHERE NOT base_failed" for k in SPREADS)
    over = " OR ".join(f"coalesce(m.m_{k} > t.t_{k}, false)" for k in SPREADS)
    limits = ", ".join(f"max(CASE WHEN metric = '{k}' THEN lim END) AS t_{k}" for k in SPREADS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT rid, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
again AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS n FROM g WHERE w3 IS NOT NULL),
starts AS (SELECT rid, i FROM again WHERE n > 1),
covered AS (SELECT DISTINCT rid, i FROM (SELECT rid, i FROM starts UNION ALL SELECT rid, i + 1 FROM starts UNION ALL SELECT rid, i + 2 FROM starts)),
r AS (SELECT rid, count(*) AS n_repeat_words FROM covered GROUP BY rid),
c AS (SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g'))::BIGINT AS n_capitals, length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_shouts
      FROM w LEFT JOIN r USING (rid)),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
        CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS m_word_length, CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS m_symbols,
        CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // (n_lines + {FEW_LINES}) ELSE 0 END AS m_dup_lines, CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS m_repeats,
        CASE WHEN word_chars > 0 THEN 1000 * n_capitals // word_chars ELSE 0 END AS m_capitals, CASE WHEN n_words > 0 THEN 1000 * n_shouts // n_words ELSE 0 END AS m_shouts
      FROM c),
l AS ({arms}),
s AS (SELECT lang, source, metric, (v >> greatest(0, length(bin(v)) - {BITS})) << greatest(0, length(bin(v)) - {BITS}) AS b, count(*) AS n FROM l GROUP BY ALL),
o1 AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, metric ORDER BY b) AS upto, sum(n) OVER (PARTITION BY lang, source, metric) AS docs FROM s),
own AS (SELECT lang, source, metric, max(docs) AS docs, min(CASE WHEN upto * 4 >= docs THEN b END) AS q1, min(CASE WHEN upto * 4 >= docs * 3 THEN b END) AS q3
        FROM o1 GROUP BY ALL),
s2 AS (SELECT lang, metric, b, sum(n) AS n FROM s GROUP BY ALL),
o2 AS (SELECT *, sum(n) OVER (PARTITION BY lang, metric ORDER BY b) AS upto, sum(n) OVER (PARTITION BY lang, metric) AS docs FROM s2),
wide AS (SELECT lang, metric, min(CASE WHEN upto * 4 >= docs THEN b END) AS w1, min(CASE WHEN upto * 4 >= docs * 3 THEN b END) AS w3 FROM o2 GROUP BY ALL),
a AS (SELECT own.lang, source, own.metric, (q1 * docs + w1 * {PRIOR_DOCS})::DOUBLE / (docs + {PRIOR_DOCS})::DOUBLE AS lo,
        (q3 * docs + w3 * {PRIOR_DOCS})::DOUBLE / (docs + {PRIOR_DOCS})::DOUBLE AS hi, {spreads.replace('metric', 'own.metric', 1)}::DOUBLE AS least
      FROM own JOIN wide ON own.lang IS NOT DISTINCT FROM wide.lang AND own.metric = wide.metric),
f AS (SELECT lang, source, metric, hi + greatest(hi - lo, least) * {REACH} AS lim FROM a),
t AS (SELECT lang, source, {limits} FROM f GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {over}) AS kept
FROM m LEFT JOIN t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source"""


SQL = _sql()
