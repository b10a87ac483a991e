"""Rating factors and biases trained together by gradient descent in epochs, over rotating blocks of users and items.

Users and items are dealt into blocks. In one stratum every block of users meets one block of items and no two meet the same, so
all blocks of a stratum are trained at once and give what training them one after the other gives. An epoch is all strata in turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.operators.evaluation import regression_summary
from brightledger.operators.graph import neighbour_weights
from brightledger.operators.recommend import MAX_RATING, RatingModel, dense_ratings, social_smoothing
from brightledger.session import drop_stage, materialise

#: Ratings of one block in one stratum, about.
BLOCK_RATINGS = 250_000
FIRST_SPREAD = 0.1


def block_count(n_ratings: int, block_ratings: int = BLOCK_RATINGS) -> int:
    return max(2, math.ceil(math.sqrt(n_ratings / block_ratings)))


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(column), column), F.lit(blocks)).cast("int")


def strata(dense: DataFrame, blocks: int, seed: int) -> DataFrame:
    """(u, i, label, stratum, block, place): the ratings by stratum and block, and their seeded order in it; stored by stratum."""
    rows = dense.select("u", "i", F.col("label").cast("double").alias("label"), _block("u", blocks).alias("block"), _block("i", blocks).alias("to"))
    rows = rows.select("u", "i", "label", F.pmod(F.col("to") - F.col("block"), F.lit(blocks)).alias("stratum"), "block",
                       F.xxhash64(F.lit(seed), "u", "i").alias("place"))
    return materialise(rows, "strata", partition_by="stratum")


def first_state(dense: DataFrame, rank: int, seed: int) -> DataFrame:
    """(kind, id, b, f): biases of 0 and small seeded factors for every user (kind 0) and item (kind 1)."""
    def side(kind, column):
        unit = [F.pmod(F.xxhash64(F.lit(seed), F.lit(kind), column, F.lit(k)), F.lit(1 << 32)) / float(1 << 32) - 0.5 for k in range(rank)]
        return dense.select(column).distinct().select(F.lit(kind).alias("kind"), F.col(column).cast("bigint").alias("id"), F.lit(0.0).alias("b"),
                                                      F.array(*[u * (FIRST_SPREAD * math.sqrt(12)) for u in unit]).alias("f"))

    return side(0, "u").unionByName(side(1, "i"))


def levels(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    """The round of each rating: after all earlier ones of its user and of its item. Ratings of a round share neither."""
    of_u, of_i, out = {}, {}, np.empty(len(u), np.int64)
    for k, (a, b) in enumerate(zip(u.tolist(), i.tolist())):
        n = max(of_u.get(a, 0), of_i.get(b, 0)) + 1
        of_u[a] = of_i[b] = out[k] = n
    return out


def descend(u, i, label, bu, bi, fu, fi, mean: float, rate: float, reg: float, top: float = MAX_RATING) -> None:
    """One pass over ratings, in place: what a loop over them in order gives, done a round at a time."""
    level = levels(u, i)
    order = np.argsort(level, kind="stable")
    ends = np.searchsorted(level[order], np.arange(1, level.max(initial=0) + 2))
    for lo, hi in zip(ends, ends[1:]):
        x = order[lo:hi]
        a, b = u[x], i[x]
        own, other = fu[a], fi[b]
        error = label[x] - np.clip(mean + bu[a] + bi[b] + np.einsum("nk,nk->n", own, other), 0.0, top)
        fu[a] = own + rate * (error[:, None] * other - reg * own)
        fi[b] = other + rate * (error[:, None] * own - reg * other)
        bu[a] += rate * (error - reg * bu[a])
        bi[b] += rate * (error - reg * bi[b])


STATE = "kind int, id bigint, b double, f array<double>"
_STATE = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("b", pa.float64()), ("f", pa.list_(pa.float64()))])
#: Rows of one packed row. Packed rows pass between Spark and Python by the thousand rows instead of one by one.
CHUNK = 4_096
# users (kind 0), items (1) and ratings (2) as bytes: id, other end, bias or label, factors; home is the block of a user or an item, a rating's is its users'
PACKED = "kind int, stratum int, home int, chunk int, id binary, other binary, b binary, f binary"
_PACKED = pa.schema([*[(c, pa.int32()) for c in ("kind", "stratum", "home", "chunk")], *[(c, pa.binary()) for c in ("id", "other", "b", "f")]])


def _packed(kind: int, stratum: int, home: int, ids: np.ndarray, other: np.ndarray, b: np.ndarray, f: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
    for n, lo in enumerate(range(0, len(ids), CHUNK), first):
        parts = [np.ascontiguousarray(x[lo:lo + CHUNK]).tobytes() for x in (ids, other, b, f)]
        yield pa.RecordBatch.from_arrays([*[pa.array([int(v)], pa.int32()) for v in (kind, stratum, home, n)], *[pa.array([v], pa.binary()) for v in parts]], schema=_PACKED)


def _numbered(batches: Iterator[pa.RecordBatch], rank: int) -> Iterator[pa.RecordBatch]:
    """Rows (kind, stratum, home, id, other, b, f) sorted by the first three, packed; chunks of one kind, stratum and home are numbered in order.

    Rows of a chunk are gathered over batches, so that chunks don't follow the size of these.
    """
    last, held, n = None, None, 0
    for x in batches:
        keys = np.stack([x.column(c).to_numpy() for c in range(3)])
        change = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)][:x.num_rows])
        for lo, hi in zip(change, [*change[1:], x.num_rows]):
            key, piece = tuple(keys[:, lo].tolist()), x.slice(lo, hi - lo)
            f = np.zeros((hi - lo, 0)) if key[0] == 2 else piece.column(6).flatten().to_numpy().reshape(-1, rank)
            new = [*[piece.column(c).to_numpy(zero_copy_only=False) for c in (3, 4, 5)], f]
            if key != last:
                if last is not None:
                    yield from _packed(*last, *held, n)
                last, held, n = key, new, 0
            else:
                held = [np.concatenate(p) for p in zip(held, new)]
            if full := len(held[0]) // CHUNK:
                yield from _packed(*last, *[c[:full * CHUNK] for c in held], n)
                n, held = n + full, [c[full * CHUNK:] for c in held]
    if last is not None:
        yield from _packed(*last, *held, n)


def packed_strata(ratings: DataFrame) -> DataFrame:
    """The rows of ``strata`` packed in their order, stored by stratum; done once for all epochs."""
    rows = ratings.select(F.lit(2).alias("kind"), F.col("stratum").cast("int").alias("stratum"), F.col("block").alias("home"), F.col("u").cast("bigint").alias("id"),
                          F.col("i").cast("bigint").alias("other"), F.col("label").alias("b"), "place")
    rows = rows.repartition("stratum", "home").sortWithinPartitions("stratum", "home", "place", "id", "other").drop("place")
    return materialise(rows.mapInArrow(lambda b: _numbered(b, 0), PACKED), "strata", partition_by="stratum")


def packed_state(state: DataFrame, blocks: int, rank: int) -> DataFrame:
    homes = [F.pmod(F.xxhash64(F.lit(c), F.col("id").cast("int")), F.lit(blocks)).cast("int") for c in ("u", "i")]
    rows = state.select("kind", F.lit(0).alias("stratum"), F.when(F.col("kind") == 0, homes[0]).otherwise(homes[1]).alias("home"), "id",
                        F.lit(0).cast("bigint").alias("other"), "b", "f")
    rows = rows.repartition("kind", "home").sortWithinPartitions("kind", "home", "id")
    return materialise(rows.mapInArrow(lambda b: _numbered(b, rank), PACKED), "state")


def unpacked_state(state: DataFrame, rank: int) -> DataFrame:
    """(kind, id, b, f) of a packed state."""
    def run(batches):
        for x in batches:
            for kind, ids, b, f in zip(*[x.column(c).to_pylist() for c in (0, 4, 6, 7)]):
                ids = np.frombuffer(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), kind), pa.int32()), pa.array(ids), pa.array(np.frombuffer(b, np.float64)),
                                                  pa.ListArray.from_arrays(np.arange(0, len(ids) * rank + 1, rank, dtype=np.int32), pa.array(np.frombuffer(f, np.float64)))], schema=_STATE)

    return materialise(state.mapInArrow(run, STATE), "state")


_RATED = "label double, prediction double"
_ARROW_RATED = pa.schema([("label", pa.float64()), ("prediction", pa.float64())])


def _by_block(batches: Iterator[pa.RecordBatch], rank: int, rated, closed) -> Iterator[pa.RecordBatch]:
    """Packed rows after their block, sorted by block and kind: users, then items, then ratings, which go by as they come.

    ``rated`` gets the ratings with the parts of users and of items (ids, biases, factors); ``closed`` gets these at a block's end, with their homes.
    A task holds the factors of one block of users and one of items.
    """
    block, parts, homes = None, None, None
    for x in batches:
        for of, kind, home, ids, other, b, f in zip(*[x.column(c).to_pylist() for c in (0, 1, 3, 5, 6, 7, 8)]):
            if of != block:
                if parts is not None:
                    yield from closed(parts, homes)
                block, parts, homes = of, [[], []], [0, 0]
            ids, b = np.frombuffer(ids, np.int64), np.frombuffer(b, np.float64)
            if kind < 2:
                own = [ids, b, np.frombuffer(f, np.float64).reshape(-1, rank)]
                parts[kind] = [np.concatenate(p) for p in zip(parts[kind], own)] if parts[kind] else [p.copy() for p in own]
                homes[kind] = home
            else:
                yield from rated(np.searchsorted(parts[0][0], ids), np.searchsorted(parts[1][0], np.frombuffer(other, np.int64)), b, parts)
    if parts is not None:
        yield from closed(parts, homes)


def _trained(batches: Iterator[pa.RecordBatch], mean: float, rate: float, reg: float, rank: int) -> Iterator[pa.RecordBatch]:
    """The packed users and items after their block is trained."""
    def rated(u, i, label, parts):
        (_, bu, fu), (_, bi, fi) = parts
        descend(u, i, label, bu, bi, fu, fi, mean, rate, reg)
        return ()

    def closed(parts, homes):
        for kind in (0, 1):
            if parts[kind]:
                yield from _packed(kind, 0, homes[kind], parts[kind][0], np.zeros(len(parts[kind][0]), np.int64), *parts[kind][1:])

    return _by_block(batches, rank, rated, closed)


def _predicted(batches: Iterator[pa.RecordBatch], mean: float, rank: int, top: float = MAX_RATING) -> Iterator[pa.RecordBatch]:
    """(label, prediction) of the ratings, as ``RatingModel.predict`` has them."""
    def rated(u, i, label, parts):
        (_, bu, fu), (_, bi, fi) = parts
        guess = np.clip(mean + bu[u] + bi[i] + np.einsum("nk,nk->n", fu[u], fi[i]), 0.0, top)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(guess)], schema=_ARROW_RATED)

    return _by_block(batches, rank, rated, lambda parts, homes: ())


def _met(state: DataFrame, ratings: DataFrame, stratum: int, blocks: int) -> DataFrame:
    """The packed state and a stratum's ratings, after their block; every block in a task of its own."""
    own = ratings.filter(F.col("stratum") == stratum).select(F.col("home").alias("block"), *_PACKED.names)
    block = F.when(F.col("kind") == 0, F.col("home")).otherwise(F.pmod(F.col("home") - stratum, F.lit(blocks))).cast("int")
    rows = state.select(block.alias("block"), *_PACKED.names).unionByName(own)
    # a hash of the block would put several blocks into one task and none into others
    return rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind", "chunk")


def train_packed(state: DataFrame, ratings: DataFrame, stratum: int, blocks: int, mean: float, rate: float, reg: float, rank: int) -> DataFrame:
    """The packed state after one stratum; every block is trained in a task of its own."""
    return materialise(_met(state, ratings, stratum, blocks).mapInArrow(lambda b: _trained(b, mean, rate, reg, rank), PACKED), "state")


def predicted(state: DataFrame, ratings: DataFrame, blocks: int, mean: float, rank: int) -> DataFrame:
    """(label, prediction) of all packed ratings by a packed state, a stratum after the other: ratings stay where they are, and factors go to them once."""
    out = None
    for stratum in range(blocks):
        out = materialise(_met(state, ratings, stratum, blocks).mapInArrow(lambda b: _predicted(b, mean, rank), _RATED), "rated", onto=out)
    return out


def train_stratum(state: DataFrame, ratings: DataFrame, stratum: int, blocks: int, mean: float, rate: float, reg: float, rank: int) -> DataFrame:
    """The state after one stratum, from plain rows of ``first_state`` and ``strata``."""
    rows = packed_strata(ratings.filter(F.col("stratum") == stratum))
    return unpacked_state(train_packed(packed_state(state, blocks, rank), rows, stratum, blocks, mean, rate, reg, rank), rank)


def fit_by_epochs(ratings: DataFrame, edges: DataFrame | None = None, ranks: DataFrame | None = None, rank: int = 20, epochs: int = 10,
                  rate: float = 0.01, reg: float = 0.02, strength: float = 0.1, decay: float = 0.95, blocks: int | None = None,
                  seed: int = 42) -> tuple[RatingModel, DataFrame]:
    """The model and (epoch, rate, mae, rmse, mse, r2) after every epoch on ``ratings`` (user_id, item_id, label).

    After an epoch users move toward those they trust (``edges`` and ``ranks``, as in ``recommend.prepare``), then the rate
    decays. A stratum's state is written under ``spark.checkpoint.dir``: a lost executor repeats one stratum at most, and the state
    before it is deleted. A user with very many ratings is trained in one task of a stratum after the other, as the method asks; its
    ratings go by in batches.
    """
    ratings = materialise(ratings.filter("user_id is not null and item_id is not null and label is not null"), "ratings")
    mean_table = materialise(ratings.agg(F.avg("label").alias("mu"), F.count("*").alias("n")), "mean")
    first = mean_table.first()
    blocks = blocks or block_count(first["n"])
    dense = materialise(dense_ratings(ratings), "dense")
    drop_stage(ratings)
    dealt = strata(dense, blocks, seed)
    rows = packed_strata(dealt)
    drop_stage(dealt)
    ids = [materialise(dense.select(F.col(c).cast("bigint").alias("id"), k).distinct(), "ids") for c, k in (("u", "user_id"), ("i", "item_id"))]
    trust = materialise(neighbour_weights(edges, ranks), "trust") if edges is not None and ranks is not None else None
    start = materialise(first_state(dense, rank, seed), "state")
    packed = packed_state(start, blocks, rank)
    for x in (dense, start):
        drop_stage(x)
    history, model, before = None, None, []
    for epoch in range(1, epochs + 1):
        for stratum in range(blocks):
            trained = train_packed(packed, rows, stratum, blocks, first["mu"], rate, reg, rank)
            drop_stage(packed)
            packed = trained
        made = [unpacked_state(packed, rank)]
        drop_stage(packed)
        state = made[0]
        users, items = (state.filter(F.col("kind") == k).join(ids[k], "id") for k in (0, 1))
        if trust is not None:
            pulled = social_smoothing(users.select("user_id", "f"), trust, rank, rate, strength)
            users = materialise(users.drop("f").join(pulled, "user_id"), "users")
            made.append(users)
            state = users.select("kind", "id", "b", "f").unionByName(state.filter("kind = 1"))
        for x in before:
            drop_stage(x)
        before = made
        model = RatingModel(mean_table.select("mu"), users.select("user_id", F.col("b").alias("b_u")), items.select("item_id", F.col("b").alias("b_i")),
                            users.select("user_id", "f"), items.select("item_id", "f"))
        packed = packed_state(state, blocks, rank)
        rated = predicted(packed, rows, blocks, first["mu"], rank)
        quality = regression_summary(rated, "label", "prediction").select(
            F.lit(epoch).alias("epoch"), F.lit(rate).alias("rate"), "mae", "rmse", "mse", "r2")
        quality = materialise(quality, "quality")
        drop_stage(rated)
        history = quality if history is None else history.unionByName(quality)
        rate *= decay
    drop_stage(packed)
    drop_stage(rows)
    return model, history
