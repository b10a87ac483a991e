"""Importance resampling toward a target: hashed word counts as bit planes, exact integer weights, a seeded draw.

A document's weight is the sum of its features' gains. Its bucket counts are cut into planes of one bit a bucket, and so are the
gains, apart by sign; a plane of counts AND a plane of gains leaves the buckets that share both bits, and their number counts
2^(both bits) each. Sums of whole numbers are exact in any order.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import map_arrow, read
from brightledger.llm.words import byte_table, crc32_of, split, translated
from brightledger.operators.ordering import with_position
from brightledger.session import materialise

BUCKETS, RUN, SEED, PERCENT, MIN_WORDS = 10_000, 1, 2024, 10, 20
#: Documents whose planes a task holds at once.
PLANE_ROWS = 512
WORD_BYTES = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122)


def features(texts: pa.Array, buckets: int = BUCKETS, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every feature of a batch of texts, and each text's number of words.

    Features are all runs of 1 to ``run`` words, joined by one space.
    """
    words, rows = split(translated(texts, WORD_BYTES))
    n_words = np.bincount(rows, minlength=len(texts))
    owner, found, joined = [rows], [crc32_of(words)], words
    for n in range(1, run):
        joined = pc.binary_join_element_wise(joined[:-1], words[n:], pa.scalar(" ", pa.large_string()))
        inside = rows[n:] == rows[:len(rows) - n]  # rows are in order: equal ends are one text
        owner.append(rows[n:][inside])
        found.append(crc32_of(joined)[inside])
    return np.concatenate(owner), np.concatenate(found).astype(np.int64) % buckets, n_words


def bucket_counts(df: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> list[int]:
    """Features of all texts by bucket. A task hands on one row a bucket at most, and ``buckets`` rows reach the driver."""

    def work(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(features(b.column(0), buckets, run)[1], minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], names=["bucket", "n"])

    rows = map_arrow(df.select("text"), work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = [0] * buckets
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: list[int], target: list[int]) -> np.ndarray:
    """A thousand times the logarithm of target to raw share, with one feature added to every bucket, rounded down."""
    n, s_all, t_all = len(raw), sum(raw), sum(target)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(raw, target)], np.int64)


def planes(keys: np.ndarray, numbers: np.ndarray, rows: int, buckets: int) -> list[np.ndarray]:
    """Bit planes of a table of non-negative numbers, lowest bit first, as rows of 64-bit words; row * buckets + bucket has its number."""
    wide = buckets + -buckets % 64
    at, out = keys // buckets * wide + keys % buckets, []
    for k in range(int(numbers.max(initial=0)).bit_length()):
        bits = np.zeros(rows * wide, bool)
        bits[at[numbers >> k & 1 == 1]] = True
        out.append(np.packbits(bits).reshape(rows, -1).view(np.uint64))
    return out


def signed_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, plane) of the gains: planes of the positive ones, then of the negative ones."""
    n = len(gain)
    return [(sign << k, plane[0]) for sign in (1, -1) for k, plane in enumerate(planes(np.arange(n), np.maximum(sign * gain, 0), 1, n)) if plane.any()]


def weights(rows: np.ndarray, found: np.ndarray, n_rows: int, sliced: list[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """Sum of gains over each row's features, from planes of counts and planes of gains."""
    out = np.zeros(n_rows, np.int64)
    for first in range(0, n_rows, PLANE_ROWS):
        lo, hi = np.searchsorted(rows, [first, first + PLANE_ROWS])
        height = min(PLANE_ROWS, n_rows - first)
        keys, counts = np.unique((rows[lo:hi] - first) * buckets + found[lo:hi], return_counts=True)
        for j, plane in enumerate(planes(keys, counts, height, buckets)):
            some = plane.any(axis=1)
            plane = plane[some]
            total = np.zeros(len(plane), np.int64)
            for power, gain in sliced:
                total += power * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
            out[first:first + height][some] += total << j
    return out


def weighed(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    buckets, sliced = len(gain), signed_planes(gain)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for b in batches:
            rows, found, n_words = features(b.column(1), buckets, run)
            order = np.argsort(rows, kind="stable") if run > 1 else slice(None)
            rows, found = rows[order], found[order]
            n = np.bincount(rows, minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n, pa.int64()), pa.array(weights(rows, found, b.num_rows, sliced, buckets))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resampled(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, run: int = RUN, seed: int = SEED, percent: int = PERCENT,
              min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``percent`` of the documents with ``min_words`` words or more are drawn toward ``target`` (text), by the highest weight plus
    seeded Gumbel noise: a draw without replacement. Ranks are 1, 2, 3 ...; rows that aren't drawn have none. Null and empty texts
    have no feature, weight 0 and no rank; very long ones are read whole. Rows repeated are scored as often and ranked one after
    the other; a null doc_id draws the noise of an empty one and comes last among equal scores. An empty target or table is well
    defined: every count is 0.

    Documents are read twice, for the counts and for the weights, and nothing of their size is written between.
    """
    gain = gains(bucket_counts(docs, buckets, run), bucket_counts(target, buckets, run))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")
    rows = weighed(docs, gain, run).withColumns({"score": F.col("weight") + noise, "open": F.col("n_words") >= min_words,
                                                 "place": F.monotonically_increasing_id()})
    rows = materialise(rows, "weighed")
    drawn = rows.agg(F.expr(f"count_if(open) * {int(percent)} div 100").alias("n")).scalar()
    placed = with_position(rows, [F.col("open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place")], name="at")
    return placed.withColumn("rank", F.when(F.col("open") & (F.col("at") < drawn), F.col("at") + 1).cast("bigint")).select(
        "doc_id", "n_words", "n_features", "weight", "score", "rank")


def op13_resampling(spark, folder):
    return resampled(read(spark, folder, "documents"), read(spark, folder, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


SQL = rf"""
WITH RECURSIVE crc AS (SELECT i, 0 AS k, i AS c FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS step FROM crc WHERE k = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, text, true AS raw FROM documents UNION ALL SELECT -row_number() OVER (), item_id, text, false FROM benchmark),
w AS (SELECT rid, doc_id, raw, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d),
f AS (SELECT rid, raw, unnest(words) AS word FROM w),
u AS (SELECT DISTINCT word FROM f),
h AS (SELECT word, hex(encode(word)) AS x FROM u),
b AS (SELECT word, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substring(x, 2 * i + 1, 2))::BIGINT) AS bytes FROM h),
e AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, c: xor(a >> 8, step[(xor(a, c) & 255) + 1])), 4294967295::BIGINT) % {BUCKETS} AS bucket
      FROM b, steps),
g AS (SELECT rid, raw, bucket FROM f JOIN e USING (word)),
n AS (SELECT bucket, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM g GROUP BY bucket),
a AS (SELECT count(*) FILTER (raw) AS ss, count(*) FILTER (NOT raw) AS tt FROM g),
y AS (SELECT bucket, floor(1000 * ln(((t + 1) * (ss + {BUCKETS}))::DOUBLE / ((s + 1) * (tt + {BUCKETS}))::DOUBLE))::BIGINT AS gain FROM n, a),
v AS (SELECT rid, sum(gain)::BIGINT AS weight FROM g JOIN y USING (bucket) WHERE raw GROUP BY rid),
k AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        ('0x' || substring(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM w LEFT JOIN v USING (rid) WHERE raw),
o AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM k),
p AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS r,
        count(*) OVER (PARTITION BY n_features >= {MIN_WORDS}) AS m FROM o)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {MIN_WORDS} AND r <= {PERCENT} * m // 100 THEN r END AS rank FROM p"""
