"""Total orders at scale: row positions, running sums, row frames and exact quantiles.

A window without PARTITION BY runs in one task. Here the rows are range-partitioned on the
full sort key, sorted inside each partition and written once; positions then follow from the
number of rows in the partitions before. Only per-partition totals (one row per task and
group) are ever combined, so no group, however large, meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightledger.session import materialise

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _as_columns(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def _sorted_stage(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``df`` sorted over all tasks and written, with task number, position in the task and the group as one struct.

    Structs compare null fields as equal, so null group keys meet each other in plain joins.
    """
    keys = _as_columns(by) + _as_columns(order)
    staged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))))
    if by:
        staged = staged.withColumn("_key", F.struct(*by))
    return materialise(staged, "ordered")


def _with_totals(staged: DataFrame, totals: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Attach the per-(task, group) columns ``names`` of ``totals``.

    Without groups there is one row per task: these enter as a one-row map and the rows aren't shuffled.
    """
    if by:
        return staged.join(totals.select("_part", "_key", *names), ["_part", "_key"])
    table = totals.agg(F.map_from_entries(F.collect_list(F.struct("_part", F.struct(*names))))).scalar()
    return staged.withColumn("_t", F.element_at(table, F.col("_part"))).select(
        *staged.columns, *[F.col(f"_t.{n}").alias(n) for n in names])


def with_position(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
                  name: str = "idx", count_name: str | None = None) -> DataFrame:
    """Add the 0-based position of each row in ``order`` within its ``by`` group.

    ``order`` must identify a row for the result to be repeatable, and then also splits
    runs of equal leading keys over partitions.
    """
    by = list(by)
    staged = _sorted_stage(df, by, order)
    group = ["_key"] if by else []
    totals = staged.groupBy("_part", *group).agg(F.count("*").alias("_in_part"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_in_part").over(before), F.lit(0)))
    names = ["_first", "_before"]
    if count_name:
        totals = totals.withColumn(count_name, F.sum("_in_part").over(Window.partitionBy(*group)))
        names.append(count_name)
    out = _with_totals(staged, totals, by, names)
    return out.withColumn(name, F.col("_pos") - F.col("_first") + F.col("_before")).drop(
        "_part", "_pos", "_key", "_first", "_before")


def with_running_sums(df: DataFrame, sums: dict[str, str], order: Sequence[str | Column],
                      by: Sequence[str] = (), totals_too: bool = False) -> DataFrame:
    """Add inclusive running sums ``{new_name: column}`` along ``order`` within ``by``.

    With ``totals_too`` the group total of each column is added as ``<new_name>_total``. The sorted rows are dealt by task
    (and group) once, for the totals and for the sums inside a task alike.
    """
    by = list(by)
    staged = _sorted_stage(df, by, order)
    key = ["_key"] if by else []
    totals = staged.groupBy("_part", *key).agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    group = Window.partitionBy(*key)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = []
    for n in sums:
        totals = totals.withColumn(f"_b_{n}", F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)))
        names.append(f"_b_{n}")
        if totals_too:
            totals = totals.withColumn(f"{n}_total", F.sum(f"_s_{n}").over(group))
            names.append(f"{n}_total")
    out = _with_totals(staged, totals, by, names)
    inside = Window.partitionBy("_part", *key).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    for n, c in sums.items():
        out = out.withColumn(n, F.sum(c).over(inside) + F.col(f"_b_{n}"))
    return out.drop("_part", "_pos", "_key", *[f"_b_{n}" for n in sums])


def over_row_frames(df: DataFrame, order: Sequence[str | Column], before: int, after: int,
                    add: Callable[[DataFrame, Window], DataFrame], by: Sequence[str] = (),
                    block_rows: int = 100_000) -> DataFrame:
    """Row-frame windows over one long series, computed block by block.

    Rows get their position; each block of ``block_rows`` positions also receives the
    ``before`` rows ahead of it and the ``after`` rows behind it, so any frame inside those
    bounds sees exactly the rows a single global window would. ``add`` receives the frame
    and an ordered window. ``_idx`` (position) and ``_n`` (series length) are available to it.
    """
    block_rows = max(block_rows, before, after)
    placed = with_position(df, order, by, name="_idx", count_name="_n")
    b = F.floor(F.col("_idx") / block_rows)
    offset = F.col("_idx") % block_rows
    copies = F.array_compact(F.array(
        b,
        F.when(offset >= block_rows - before, b + 1),
        F.when((offset < after) & (b > 0), b - 1)))
    spread = placed.withColumn("_home", b).withColumn("_block", F.explode(copies))
    w = Window.partitionBy(*by, "_block").orderBy("_idx")
    return add(spread, w).filter("_block = _home").drop("_home", "_block", "_idx", "_n")


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linearly interpolated quantiles ``{name: p}`` per group.

    Equal values are counted before the shuffle; ranks come from running counts.
    """
    by = list(by)
    counted = df.filter(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("_v")).agg(
        F.count("*").alias("_c"))
    ranked = with_running_sums(counted, {"_hi": "_c"}, ["_v"], by, totals_too=True)
    ranked = ranked.withColumn("_lo", F.col("_hi") - F.col("_c"))
    aggs = []
    for name, p in probs.items():
        h = (F.col("_hi_total") - 1) * F.lit(float(p))
        for edge, rank in (("f", F.floor(h)), ("c", F.ceil(h))):
            hit = (F.col("_lo") <= rank) & (rank < F.col("_hi"))
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{edge}_{name}"))
    out = ranked.groupBy(*by).agg(F.max("_hi_total").alias("_n"), *aggs)
    picks = []
    for name, p in probs.items():
        h = (F.col("_n") - 1) * F.lit(float(p))
        low, high = F.col(f"_f_{name}"), F.col(f"_c_{name}")
        picks.append((low + (h - F.floor(h)) * (high - low)).alias(name))
    return out.select(*by, *picks)


def selected_quantiles(df: DataFrame, columns: Sequence[str], probs: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """Exact linearly interpolated quantiles ``{name: p}`` of listed columns by selection: (column, names), nulls are ignored.

    Each wanted rank is enclosed by two values of a mergeable sketch; a pass counts the rows below, at and between them; the
    range between (about 4 / ``accuracy`` of the rows) is enclosed anew until the rank falls on an end. Columns are neither put in
    order nor shuffled; a few passes do for any size. A column of which a sketch misses a rank is ranked in full.
    Only a few numbers for each listed column and quantile pass the driver.
    """
    columns, names = list(columns), list(probs)
    value = {c: F.col(c).cast("double") for c in columns}
    size = dict(zip(columns, df.agg(*[F.count(value[c]) for c in columns]).first()))
    place = {(c, n): (size[c] - 1) * float(probs[n]) for c in columns if size[c] for n in names}
    # a rank's range, open at both ends: its ends, rows up to its lower end, rows inside
    open_ = {(c, r): (None, None, 0, size[c]) for (c, _), h in place.items() for r in (math.floor(h), math.ceil(h))}
    found, missed = {}, set()
    while open_:
        asked: dict[tuple, list[float]] = {}
        for (c, r), (lo, hi, below, held) in open_.items():
            reach = 2 / accuracy if 4 * held > accuracy else 0.25 / held
            middle = (r - below + 1) / held
            asked.setdefault((c, lo, hi), []).extend((max(0.0, middle - reach), min(1.0, middle + reach)))
        drawn = df.agg(*[F.percentile_approx(F.when(_between(value[c], lo, hi), value[c]), ps, accuracy) for (c, lo, hi), ps in asked.items()]).first()
        ends = {k: iter(v) for k, v in zip(asked, drawn)}
        closer = {(c, r): (next(ends[c, lo, hi]), next(ends[c, lo, hi])) for (c, r), (lo, hi, _, _) in open_.items()}
        parts = []
        for (c, r), (a, b) in closer.items():
            v, within = value[c], _between(value[c], *open_[c, r][:2])
            parts += [F.count_if(k & within) for k in (v < a, v == a, (v > a) & (v < b), (v == b) & F.lit(a != b))]
        counts = iter(df.agg(*parts).first())
        left = {}
        for (c, r), (a, b) in closer.items():
            below = open_[c, r][2]
            under, at_a, inside, at_b = (next(counts) for _ in range(4))
            k = r - below - under
            if k < 0 or k >= at_a + inside + at_b:
                missed.add(c)
            elif k < at_a:
                found[c, r] = a
            elif k < at_a + inside:
                left[c, r] = (a, b, below + under + at_a, inside)
            else:
                found[c, r] = b
        open_ = {(c, r): v for (c, r), v in left.items() if c not in missed}

    def between(c: str, h: float) -> float:
        low, high = found[c, math.floor(h)], found[c, math.ceil(h)]
        return low + (h - math.floor(h)) * (high - low) if low != high else low

    rows = [(c, *[float(between(c, place[c, n])) for n in names]) for c in columns if size[c] and c not in missed]
    out = df.sparkSession.createDataFrame(rows, ", ".join(["column string", *[f"`{n}` double" for n in names]]))
    if not missed:
        return out
    whole = [F.struct(F.lit(c).alias("column"), value[c].alias("value")) for c in columns if c in missed]
    return out.unionByName(exact_quantiles(df.select(F.inline(F.array(*whole))), "value", probs, ["column"]))


def _between(v: Column, low: float | None, high: float | None) -> Column:
    out = v.isNotNull()
    out = out if low is None else out & (v > low)
    return out if high is None else out & (v < high)


def top_fraction(df: DataFrame, score: Column, fraction: float, tie_break: Sequence[str]) -> DataFrame:
    """Rows among the ``max(1, int(fraction * n))`` highest scores; a null score is the lowest.

    The score that the fraction ends in is found from counts of scores; only rows of that score are put in order.
    """
    scored = df.withColumn("_score", F.coalesce(score.cast("double"), F.lit(float("-inf"))))
    counts = scored.groupBy("_score").agg(F.count("*").alias("_c"))
    upto = with_running_sums(counts, {"_hi": "_c"}, [F.col("_score").desc()], totals_too=True)
    k = F.greatest(F.lit(1), F.floor(F.col("_hi_total") * F.lit(fraction)))
    last = upto.filter(F.col("_hi") >= k).agg(F.max(F.struct("_score", (F.col("_hi") - F.col("_c")).alias("before"), k.alias("k"))).alias("r")).first()["r"]
    if last is None:
        return df
    edge = F.lit(last["_score"])
    ties = with_position(scored.filter(F.col("_score") == edge), list(tie_break), name="_idx").filter(
        F.col("_idx") < last["k"] - last["before"])
    return scored.filter(F.col("_score") > edge).drop("_score").unionByName(ties.drop("_score", "_idx"))
