"""Joins: interval, range-lookup, pair, overlap and greedy matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions.geometry import box_overlap_ratio, great_circle_km
from brightledger.operators.rows import BOX_COLUMNS
from brightledger.operators.skew import salted_join
from brightledger.session import materialise

#: Boxes of both kinds in an image, and pairs in one, that are compared without being spread.
CROWDED, CROWDED_PAIRS = 128, 512


def above_average(txns: DataFrame, averages: DataFrame, key: str, factor: float) -> DataFrame:
    """Rows whose amount exceeds ``factor`` times the average of their key.

    ``averages`` holds one row per key. It grows with the data, so it carries no broadcast
    hint: the planner broadcasts it only when its measured size allows. A hot key is spread.
    """
    return salted_join(txns, averages, [key]).filter(F.col("amount") > F.col("average_amount") * factor)


def pairs_within_seconds(events: DataFrame, key: str, seconds: int, time_column: str = "ts",
                         carry: Sequence[str] = ()) -> DataFrame:
    """Ordered pairs of one key with ``0 < t2 - t1 <= seconds`` (whole seconds).

    Both sides meet on (key, time slot): a slot is ``seconds`` wide, so a later partner lies in
    the same slot or the next. A hot key is thereby split over its time line, and each pair is
    produced once, in the slot of its later row.
    """
    slot = F.floor(F.unix_timestamp(time_column) / seconds)
    cols = [key, F.unix_timestamp(time_column).alias("_s"), *carry]
    first = events.select(*cols, F.explode(F.array(slot, slot + 1)).alias("_slot"))
    second = events.select(*cols, slot.alias("_slot"))
    a = first.select(key, "_slot", F.col("_s").alias("_s1"), *[F.col(c).alias(f"{c}_1") for c in carry])
    b = second.select(key, "_slot", F.col("_s").alias("_s2"), *[F.col(c).alias(f"{c}_2") for c in carry])
    gap = F.col("_s2") - F.col("_s1")
    return a.join(b, [key, "_slot"]).filter((gap > 0) & (gap <= seconds)).withColumn(
        "gap_seconds", gap).drop("_slot", "_s1", "_s2")


def distant_pairs(events: DataFrame, key: str, seconds: int, km: float, time_column: str = "ts",
                  carry: Sequence[str] = ()) -> DataFrame:
    """Pairs of one key that lie further apart than can be travelled in the time."""
    pairs = pairs_within_seconds(events, key, seconds, time_column, ["lat", "lng", time_column, *carry])
    distance = great_circle_km(*[F.col(c) for c in ("lat_1", "lng_1", "lat_2", "lng_2")])
    return pairs.withColumn("distance_km", distance).filter(F.col("distance_km") > km)


def trailing_day_mean(targets: DataFrame, history: DataFrame, day: str, value: str, days: int = 7,
                      name: str = "trailing_mean") -> DataFrame:
    """Mean of history rows dated in ``[d - days, d)`` for each target day; NULL if there are none.

    History is summed per day first; each daily sum is then handed to the ``days`` target days
    it serves, so the join is an equi-join on the day.
    """
    daily = history.groupBy(day).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    serves = F.explode(F.sequence(F.date_add(day, 1), F.date_add(day, days)))
    spread = daily.select(serves.alias(day), "_s", "_c").groupBy(day).agg(
        F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    return targets.join(spread, day, "left").withColumn(name, F.try_divide("_s", "_c")).drop("_s", "_c")


def group_pairs(items: DataFrame, group: str, item: str, carry: Sequence[str] = (), block: int = 1_000) -> DataFrame:
    """Every unordered pair inside a group (a round-robin draw): the pairs are the result.

    A group is cut into blocks of about ``block`` items and each pair of blocks meets on a key of its own, so a task
    holds two blocks however large the group is.
    """
    sizes = items.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    placed = salted_join(items.select(group, item, *carry), sizes, [group], spread_by=[item])
    placed = placed.withColumn("_own", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cols = [item, *carry]
    a = placed.select(group, F.col("_own").alias("_i"), F.col("_other").alias("_j"), *[F.col(c).alias(f"{c}_a") for c in cols])
    b = placed.select(group, F.col("_other").alias("_i"), F.col("_own").alias("_j"), *[F.col(c).alias(f"{c}_b") for c in cols])
    return a.join(b, [group, "_i", "_j"]).filter(F.col(f"{item}_a") < F.col(f"{item}_b")).drop("_i", "_j")


def latest_per_key(df: DataFrame, key: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``, as a map-side combined aggregate (no window, no sort)."""
    best = F.max_by(F.struct(*keep), F.struct(*order))
    return df.groupBy(key).agg(best.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in keep])


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    best = F.min_by(F.struct(*keep), F.struct(*order))
    return df.groupBy(*key).agg(best.alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in keep])


def crowded_images(truth: DataFrame, guesses: DataFrame, image: str = "filename", most: int = CROWDED) -> DataFrame | None:
    """Images with more than ``most`` boxes of both kinds together, as a stored table; None if there are none."""
    sizes = truth.select(image).unionByName(guesses.select(image)).groupBy(image).agg(F.count("*").alias("_n"))
    crowded = materialise(sizes.filter((F.col("_n") > most) & F.col(image).isNotNull()).select(image), "crowded")
    return None if crowded.isEmpty() else crowded


def overlapping_boxes(truth: DataFrame, guesses: DataFrame, image: str = "filename", truth_id: str = "box_id",
                      guess_id: str = "pred_id", cell: int = 64, most: int = CROWDED) -> DataFrame:
    """Overlapping (truth, guess) pairs per image with their overlap ratio.

    Boxes of an image with at most ``most`` boxes meet on the image: each is shuffled once and compared with fewer than ``most`` others.
    Those of crowded images meet on (image, grid cell), so a crowded image is spread over its cells.
    """
    crowded = crowded_images(truth, guesses, image, most)
    if crowded is None:
        return _overlaps_by_image(truth, guesses, image, truth_id, guess_id)
    few, many = ([salted_join(df, crowded, [image], how, spread_by=[c]) for df, c in ((truth, truth_id), (guesses, guess_id))] for how in ("left_anti", "left_semi"))
    return _overlaps_by_image(*few, image, truth_id, guess_id).unionByName(_overlaps_by_cell(*many, image, truth_id, guess_id, cell))


def _box_side(df: DataFrame, image: str, ident: str, p: str) -> DataFrame:
    return df.select(image, F.col(ident), *[F.col(c).alias(p + c) for c in BOX_COLUMNS])


def _overlaps_by_image(truth: DataFrame, guesses: DataFrame, image: str, truth_id: str, guess_id: str) -> DataFrame:
    pairs = _box_side(truth, image, truth_id, "t_").join(_box_side(guesses, image, guess_id, "g_"), image)
    return pairs.withColumn("iou", box_overlap_ratio("t_", "g_")).filter("iou > 0").select(image, truth_id, guess_id, "iou")


def _overlaps_by_cell(truth: DataFrame, guesses: DataFrame, image: str, truth_id: str, guess_id: str, cell: int) -> DataFrame:
    """A pair is kept only in the cell that holds the top-left corner of its intersection."""
    def side(df, ident, p):
        named = _box_side(df, image, ident, p)
        for axis in ("x", "y"):  # the grid cells the box touches
            first, last = (F.floor(F.col(f"{p}{axis}{end}") / cell).cast("int") for end in ("min", "max"))
            named = named.withColumn(f"_cell_{axis}", F.explode(F.sequence(first, last)))
        return named

    pairs = side(truth, truth_id, "t_").join(side(guesses, guess_id, "g_"), [image, "_cell_x", "_cell_y"])
    corner_x = F.floor(F.greatest("t_xmin", "g_xmin") / cell)
    corner_y = F.floor(F.greatest("t_ymin", "g_ymin") / cell)
    home = (F.col("_cell_x") == corner_x) & (F.col("_cell_y") == corner_y)
    ratio = box_overlap_ratio("t_", "g_")
    return pairs.filter(home).withColumn("iou", ratio).filter("iou > 0").select(image, truth_id, guess_id, "iou")


def best_overlap(truth: DataFrame, guesses: DataFrame, image: str = "filename", truth_id: str = "box_id", cell: int = 64,
                 most: int = CROWDED) -> DataFrame:
    """Best overlap of every truth box; 0 where nothing overlaps.

    In an image with at most ``most`` boxes every truth box meets the list of all guesses. Equal boxes of a crowded image are merged
    before they are compared by cell, so the work there follows its distinct boxes; the result is handed to every row with that box.
    """
    def by_image(truth, guesses):
        lists = guesses.groupBy(image).agg(F.collect_set(F.struct(*BOX_COLUMNS)).alias("_guesses"))
        ratios = F.transform("_guesses", lambda g: box_overlap_ratio(F.struct(*BOX_COLUMNS), g))
        best = F.array_max(F.filter(ratios, lambda r: r > 0))
        return truth.select(image, truth_id, *BOX_COLUMNS).join(lists, image, "left").select(
            image, truth_id, F.coalesce(best, F.lit(0.0)).alias("best_iou"))

    crowded = crowded_images(truth, guesses, image, most)
    if crowded is None:
        return by_image(truth, guesses)
    few, many = ([salted_join(df, crowded, [image], how, spread_by=BOX_COLUMNS) for df in (truth, guesses)] for how in ("left_anti", "left_semi"))
    return by_image(*few).unionByName(_best_overlap_by_cell(*many, image, truth_id, cell))


def _best_overlap_by_cell(truth: DataFrame, guesses: DataFrame, image: str, truth_id: str, cell: int) -> DataFrame:
    box = F.struct(*BOX_COLUMNS)
    distinct_truth, distinct_guesses = (
        df.select(image, *BOX_COLUMNS).distinct().withColumn("_box", box) for df in (truth, guesses))
    pairs = _overlaps_by_cell(distinct_truth, distinct_guesses.withColumnRenamed("_box", "_guess"), image, "_box", "_guess", cell)
    best = pairs.groupBy(image, "_box").agg(F.max("iou").alias("best_iou")).select(image, "_box.*", "best_iou")
    rows = truth.select(image, truth_id, *BOX_COLUMNS)
    return salted_join(rows, best, [image, *BOX_COLUMNS], "left", spread_by=[truth_id]).select(
        image, truth_id, F.coalesce("best_iou", F.lit(0.0)).alias("best_iou"))


def greedy_matches(pairs: DataFrame, image: str = "filename", truth_id: str = "box_id", guess_id: str = "pred_id",
                   threshold: float = 0.5, most: int = CROWDED_PAIRS) -> DataFrame:
    """Guesses in id order each take their best still-free truth box with ``iou >= threshold``; ties go to the lower box id.

    The pairs of an image with at most ``most`` of them are gone through in one list; larger images (and those with a null id) go
    through rounds of deferred acceptance.
    """
    live = materialise(pairs.filter(F.col("iou") >= threshold).select(image, truth_id, guess_id, "iou"), "pairs")
    unnamed = F.count_if(F.col(image).isNull() | F.col(truth_id).isNull() | F.col(guess_id).isNull())
    sizes = live.groupBy(image).agg(F.count("*").alias("_n"), unnamed.alias("_unnamed"))
    # a null image is equal to itself here
    large = materialise(sizes.filter((F.col("_n") > most) | (F.col("_unnamed") > 0)).select(F.struct(image).alias("_image")), "crowded")
    if large.isEmpty():
        return _matches_by_list(live, image, truth_id, guess_id)
    keyed = live.withColumn("_image", F.struct(image))
    few, many = (salted_join(keyed, large, ["_image"], how, spread_by=[truth_id, guess_id]).drop("_image") for how in ("left_anti", "left_semi"))
    return _matches_by_list(few, image, truth_id, guess_id).unionByName(_matches_by_rounds(many, image, truth_id, guess_id))


def _matches_by_list(pairs: DataFrame, image: str, truth_id: str, guess_id: str) -> DataFrame:
    """What going through the guesses one after the other gives, for images whose pairs make a short list."""
    kinds = {c: pairs.schema[c].dataType.simpleString() for c in (truth_id, guess_id, "iou")}
    wanted = F.sort_array(F.collect_list(F.struct(F.col(guess_id).alias("guess"), (-F.col("iou")).alias("less"), F.col(truth_id).alias("truth"))))
    none = F.array().cast(f"array<struct<guess:{kinds[guess_id]},less:{kinds['iou']},truth:{kinds[truth_id]}>>")

    def step(taken: Column, p: Column) -> Column:
        # pairs of a guess follow one another, so a guess that has a box is the last one taken
        served = F.coalesce(F.get(taken, F.size(taken) - 1)["guess"] == p["guess"], F.lit(False))
        return F.when(served | F.exists(taken, lambda x: x["truth"] == p["truth"]), taken).otherwise(F.concat(taken, F.array(p)))

    matched = pairs.groupBy(image).agg(wanted.alias("_w")).select(image, F.explode(F.aggregate("_w", none, step)).alias("_m"))
    return matched.select(image, F.col("_m.truth").alias(truth_id), F.col("_m.guess").alias(guess_id), (-F.col("_m.less")).alias("iou"))


def _matches_by_rounds(pairs: DataFrame, image: str, truth_id: str, guess_id: str) -> DataFrame:
    """Deferred acceptance gives exactly the sequential outcome: every guess asks for its best box, a box holds the earliest guess
    that asks for it and strikes all later ones from its pairs, until no box is asked for twice. All images and all
    boxes advance in the same round; a round is one written table.
    """
    live = materialise(pairs, "pairs")
    left = live.count()
    while True:
        preference = F.struct((-F.col("iou")).alias("_rank"), F.col(truth_id))
        best = live.groupBy(image, guess_id).agg(F.min(preference).alias("_b")).select(
            image, guess_id, F.col(f"_b.{truth_id}").alias(truth_id), (-F.col("_b._rank")).alias("iou"))
        held = best.groupBy(image, truth_id).agg(F.min(guess_id).alias("_held"))
        kept = materialise(salted_join(live, held, [image, truth_id], "left", spread_by=[guess_id]).filter(
            F.col("_held").isNull() | (F.col(guess_id) <= F.col("_held"))).drop("_held"), "pairs")
        now = kept.count()
        if now == left:
            return best.select(image, truth_id, guess_id, "iou")
        live, left = kept, now
