"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brightledger.llm.common import batch, map_arrow, named, read
from brightledger.llm.components import connected_components
from brightledger.session import materialise

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints are cut into this many blocks; those within MAX_BITS agree in all but MAX_BITS of them.
BLOCKS = 7
#: Shingles whose bits are counted at once.
BIT_BLOCK = 1 << 16
#: Fingerprints of one bucket that a task compares at once; larger buckets are compared piece by piece over many tasks.
PIECE = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash, as a signed long. ``bytes.lower`` and ``bytes.split`` touch ASCII only, as asked."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*[words[i:] for i in range(shingle)])), len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BIT_BLOCK):
        bits = np.unpackbits(hashes[i:i + BIT_BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())],
                                             names=["doc_id", "fp"])

    return map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, fp bigint")


def block_masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    """Masks (signed) of every choice of ``blocks - max_bits`` blocks: a close pair is equal under one of them."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    each = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(each, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (parents, children) that join exactly what is joined by pairs within ``max_bits``; never all pairs."""
    left = np.arange(len(fps))
    parents, children = [], []
    while left.size:
        front, left = left[:1], left[1:]
        while front.size and left.size:
            parent = np.full(left.size, -1)
            for i in range(0, front.size, 256):
                part = front[i:i + 256]
                near = np.bitwise_count(fps[left][:, None] ^ fps[part][None, :]) <= max_bits
                hit = near.any(axis=1) & (parent < 0)
                parent[hit] = part[near[hit].argmax(axis=1)]
            found = parent >= 0
            parents.append(parent[found])
            children.append(left[found])
            front, left = left[found], left[~found]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *parents]), np.concatenate([none, *children])


LINKS = "mask int, masked bigint, piece bigint, a bigint, b bigint"
_LINKS = pa.schema([("mask", pa.int32()), ("masked", pa.int64()), ("piece", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _bucket_links(batches, max_bits: int, limit: int):
    """Links inside each bucket of rows sorted by (mask, masked).

    A bucket of more than ``limit`` rows isn't compared here: its rows come back with the number of their piece.
    At most one piece and one batch are held at a time.
    """

    def links(fps):
        a, b = forest(fps, max_bits)
        n = len(a)
        return batch(_LINKS, np.zeros(n, np.int32), np.zeros(n, np.int64), np.full(n, -1), fps[a].view(np.int64), fps[b].view(np.int64))

    def piece(mask, masked, number, fps):
        n = len(fps)
        return batch(_LINKS, np.full(n, mask, np.int32), np.full(n, masked), np.full(n, number), fps.view(np.int64), np.zeros(n, np.int64))

    def small(mask, masked, fps):
        """All pairs of neighbouring rows up to the largest bucket's size apart; for buckets of a few rows."""
        a, b, apart = [], [], 1
        same = np.ones(len(fps), bool)
        while True:
            same = (mask[apart:] == mask[:-apart]) & (masked[apart:] == masked[:-apart])
            if not same.any():
                break
            near = same & (np.bitwise_count(fps[apart:] ^ fps[:-apart]) <= max_bits)
            a.append(fps[:-apart][near])
            b.append(fps[apart:][near])
            apart += 1
        if not a:
            return None
        a, b = np.concatenate(a), np.concatenate(b)
        n = len(a)
        return batch(_LINKS, np.zeros(n, np.int32), np.zeros(n, np.int64), np.full(n, -1), a.view(np.int64), b.view(np.int64))

    open_key, open_rows, given = None, np.zeros(0, np.uint64), 0  # the bucket that may go on in the next batch
    for x in batches:
        mask, masked, fps = (x.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        fps = fps.view(np.uint64)
        if not len(fps):
            continue
        starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (masked[1:] != masked[:-1])])
        ends = np.r_[starts[1:], len(fps)]
        few = ends - starts <= 16
        few[[0, -1]] = False
        if few.any():
            inside = np.repeat(few, ends - starts)
            if (found := small(mask[inside], masked[inside], fps[inside])) is not None:
                yield found
        for i in np.flatnonzero(~few):
            key, rows = (mask[starts[i]], masked[starts[i]]), fps[starts[i]:ends[i]]
            if key != open_key:
                if given and len(open_rows):
                    yield piece(*open_key, given, open_rows)
                elif len(open_rows) > 1:
                    yield links(open_rows)
                open_key, open_rows, given = key, rows, 0
            else:
                open_rows = np.concatenate([open_rows, rows])
            while len(open_rows) > limit:
                yield piece(*open_key, given, open_rows[:limit])
                open_rows, given = open_rows[limit:], given + 1
    if given and len(open_rows):
        yield piece(*open_key, given, open_rows)
    elif len(open_rows) > 1:
        yield links(open_rows)


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, limit: int = PIECE) -> DataFrame:
    """Links (a, b) that join distinct fingerprints (column fp) exactly as all pairs within ``max_bits`` would.

    A fingerprint goes once to each of its buckets (35 for 4 bits in 7 blocks); buckets are keys of about 27 bits.
    """
    masks = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks(max_bits, blocks)])
    keyed = fps.select(F.posexplode(masks).alias("mask", "masked"), "fp")
    dealt = keyed.repartition("mask", "masked").sortWithinPartitions("mask", "masked")
    found = materialise(map_arrow(dealt, lambda batches: _bucket_links(batches, max_bits, limit), LINKS), "simhash")
    near = found.filter("piece = -1").select("a", "b")
    crowded = found.filter("piece >= 0").select("mask", "masked", "piece", "a")
    last = crowded.groupBy("mask", "masked").agg(F.max("piece").alias("last"))
    other = F.explode(F.expr("filter(sequence(0L, last), x -> x <> piece)")).alias("other")
    pairs = crowded.join(last, ["mask", "masked"]).select("mask", "masked", "piece", "a", other).select(
        "mask", "masked", "a", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"))

    def compare(rows):
        import pandas as pd

        own = rows["a"].to_numpy().view(np.uint64)
        a, b = forest(own, max_bits)
        return pd.DataFrame({"a": own[a].view(np.int64), "b": own[b].view(np.int64)})

    more = pairs.groupBy("mask", "masked", "i", "j").applyInPandas(compare, "a bigint, b bigint")
    return near.unionByName(more).distinct()


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id, fp) for every row of ``docs`` (doc_id, text; other columns are ignored).

    A null text is an empty one: fingerprint zero, linked like any other. Rows repeated come back as often. A row with a null
    doc_id links like others but never names its component; a component of such rows only has a null component_id.
    Exact copies meet as one fingerprint, so a hot group costs one node; links and components are over fingerprints.
    """
    rows = materialise(with_fingerprints(docs, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(fingerprint_links(nodes.select("fp"), max_bits))
    classes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    classes = materialise(classes, "classes")
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its near-duplicate group, one row for each.

    Rows with a null doc_id stay only where a group has no other, one for all of them together. Of rows with the same
    doc_id the one with the smallest hash over all columns stays. Only rows of repeated ids are fingerprinted again.
    """
    groups = simhash_groups(docs, shingle, max_bits)
    ids = groups.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count("*").alias("_rows"), F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("_kept"))
    ids = materialise(ids.filter("_kept"), "kept")
    single, repeated = ids.filter("_rows = 1"), ids.filter("_rows > 1")

    def of(rows, those):
        # the ids grow with the documents: they are merged at every size, never sent to all executors
        return rows.join(those.hint("merge"), rows["doc_id"].eqNullSafe(those["_id"]), "left_semi")

    if repeated.isEmpty():
        return of(docs, single)

    kind = docs.schema["doc_id"].dataType
    packed = of(docs, repeated).select("doc_id", "text", F.struct(*named(docs)).alias("row"))  # one column, whatever the names in it

    def add(batches):
        for b in batches:
            fps = pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), fps], names=["doc_id", "row", "fp"])

    marked = map_arrow(packed, add, StructType([StructField("doc_id", kind), StructField("row", packed.schema["row"].dataType), StructField("fp", LongType())]))
    stay = of(groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))), repeated).select(
        F.col("doc_id").alias("_id"), F.col("fp").alias("_own")).distinct()
    those = marked.join(stay, marked["doc_id"].eqNullSafe(stay["_id"]) & (marked["fp"] == stay["_own"]), "left_semi")
    first = those.groupBy("doc_id").agg(F.min_by("row", F.xxhash64(*[F.col("row").getField(c) for c in docs.columns])).alias("row"))
    return of(docs, single).unionByName(first.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def op2_simhash(spark, folder):
    return simhash_groups(read(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def stage(spark, docs, folder):
    """One document of each near-duplicate group; nulls, empty and very long texts and repeated rows as in ``one_of_each``."""
    return one_of_each(docs)
