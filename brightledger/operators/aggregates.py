"""Group aggregates, frequency tables, descriptions and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightledger.operators.arrays import column_range
from brightledger.operators.ordering import exact_quantiles, selected_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def category_commission(txns: DataFrame) -> DataFrame:
    """Totals, average, size, commission ratio and status counts per merchant category."""
    return txns.groupBy("merchant_category").agg(
        F.sum("amount").alias("total_amount"), F.avg("amount").alias("avg_amount"),
        F.count("*").alias("n_txn"), F.sum("commission_amount").alias("total_commission"),
        F.count_if(F.col("commission_type") == "flat").alias("n_flat"),
        F.count_if(F.col("commission_type") == "progressive").alias("n_progressive"),
        F.count_if(F.col("commission_type") == "tiered").alias("n_tiered"),
    ).withColumn("commission_ratio", F.try_divide("total_commission", "total_amount"))


def counts_and_sums(df: DataFrame, keys: Sequence[str | Column], measure: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(measure).alias("total"))


def frequency(df: DataFrame, keys: Sequence[str], relative: str | None = None, scale: float = 1.0) -> DataFrame:
    """Counts per key; with ``relative`` also the share of all rows.

    The total is a one-row subquery, so the shares need no single-task window.
    """
    out = df.groupBy(*keys).agg(F.count("*").alias("n"))
    if relative:
        total = df.agg(F.count("*")).scalar()
        out = out.withColumn(relative, F.col("n") * scale / total)
    return out


def spread_of_counts(df: DataFrame, key: str) -> DataFrame:
    """Mean and sample variance of the number of rows per key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.avg("n").alias("mean_count"), F.var_samp("n").alias("var_count"))


_MOMENTS = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max; one row per column, by passes that neither sort nor shuffle it."""
    v = {c: F.col(c).cast("double") for c in columns}
    one = df.agg(*[fn(v[c]).alias(f"{name}{i}") for i, c in enumerate(columns) for name, fn in _MOMENTS.items()])
    basic = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in _MOMENTS])
                                          for i, c in enumerate(columns)])))
    return basic.join(selected_quantiles(df, columns, QUARTILES), "column", "left")


def to_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column, value) rows; values as double."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keys, F.inline(cells))


def group_matrix(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, min, max and count of each column per group, in long form."""
    return to_long(df, columns, [key]).groupBy(key, "column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.count("value").alias("n"))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values: count, percentage and type. One pass over the table."""
    types = dict(df.dtypes)
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.isnull(c)).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing"), F.lit(types[c]).alias("dtype"))
                      for c in df.columns])
    return one.select("_n", F.inline(cells)).filter("n_missing > 0").withColumn(
        "pct_missing", 100.0 * F.col("n_missing") / F.col("_n")).drop("_n")


def box_plot(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers (extreme values inside the fences) per group."""
    by = list(by)
    q = exact_quantiles(df, column, QUARTILES, by)
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    counted = df.groupBy(*by, column).agg(F.count("*").alias("_c"))  # duplicates cannot move a minimum
    inside = counted.join(q, by).filter(
        (F.col(column) >= F.col("q1") - fence) & (F.col(column) <= F.col("q3") + fence))
    whiskers = inside.groupBy(*by).agg(F.min(column).alias("whisker_low"), F.max(column).alias("whisker_high"))
    return q.join(whiskers, by)


def histogram(df: DataFrame, column: str, bins: int, density: bool = False) -> DataFrame:
    """Equal-width bins 1..bins over the value range; the maximum belongs to the last bin."""
    lo, hi = column_range(df, column)
    v = df.filter(F.col(column).isNotNull()).select(column, lo.alias("_lo"), hi.alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.floor((F.col(column) - F.col("_lo")) / width).cast("int") + 1
    b = F.when(F.col("_hi") == F.col("_lo"), 1).otherwise(F.least(place, F.lit(bins)))
    out = v.groupBy(b.alias("bin")).agg(
        F.count("*").alias("n"), F.any_value("_lo").alias("_lo"), F.any_value("_hi").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    out = out.withColumn("lower", F.col("_lo") + (F.col("bin") - 1) * width)
    if density:
        total = df.agg(F.count(column)).scalar()
        out = out.withColumn("density", F.try_divide(F.col("n"), total * width))
    return out.drop("_lo", "_hi")


def kernel_density(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """Gaussian density on an even grid from min - 3h to max + 3h, Scott's bandwidth.

    Equal values are merged first; each value then adds to all grid points through one
    aggregate per point, summed map-side: rows are never multiplied by the grid.
    """
    stats = df.agg(F.struct(
        F.count(column).alias("n"), F.stddev_samp(column).alias("s"),
        F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))).scalar()
    v = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count("*").alias("c")).withColumn("_s", stats)
    h = F.col("_s.s") * F.pow(F.col("_s.n"), F.lit(-0.2))
    start, stop = F.col("_s.lo") - 3 * h, F.col("_s.hi") + 3 * h
    v = v.withColumn("h", h).withColumn("start", start).withColumn("step", (stop - start) / (points - 1))

    def at(i):
        u = (F.col("v") - F.col("start") - i * F.col("step")) / F.col("h")
        return F.sum(F.col("c") * F.exp(-0.5 * u * u)).alias(f"g{i}")

    sums = v.agg(F.any_value("h").alias("h"), F.any_value("start").alias("start"), F.any_value("step").alias("step"),
                 F.sum("c").alias("n"), *[at(i) for i in range(points)])
    cells = F.array(*[F.struct(F.lit(i).alias("point"), F.col(f"g{i}").alias("g")) for i in range(points)])
    return sums.select("h", "start", "step", "n", F.inline(cells)).select(
        "point", (F.col("start") + F.col("point") * F.col("step")).alias("x"),
        (F.col("g") / (F.col("n") * F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5))).alias("density"))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence, prefix: str = "") -> DataFrame:
    """Counts of ``rows`` by the listed ``columns`` values; absent pairs are 0."""
    return df.groupBy(rows).agg(*[F.count_if(F.col(columns) == v).alias(f"{prefix}{v}") for v in values])


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, the smallest of ties: counts first, then one best row."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")).agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias("_m")).select(
        F.col("_m.v").alias(column))


def target_means(df: DataFrame, category: str, label: str, name: str = "encoded") -> DataFrame:
    """Mean label of the category, on every row. Means are one row per category."""
    means = df.groupBy(category).agg(F.avg(label).alias(name))
    return df.join(means, category, "left")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Negative / positive ratio and the balanced weight of each class, n / (2 * n_class)."""
    pos, neg, n = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0), F.count(label)
    return df.agg(F.try_divide(neg, pos).alias("pos_weight"), F.try_divide(n, 2 * neg).alias("weight_0"),
                  F.try_divide(n, 2 * pos).alias("weight_1"))


def standings(matches: DataFrame, top: int = 2) -> DataFrame:
    """3/1/0 points per match result; best ``top`` per group by points, then name.

    The rank filter is pushed below the shuffle by the planner (only the best rows of each
    task are sent), so a large group is not collected.
    """
    diff = F.col("score_a") - F.col("score_b")
    points_a = F.when(diff > 0, 3).when(diff == 0, 1).otherwise(0)
    points_b = F.when(diff < 0, 3).when(diff == 0, 1).otherwise(0)
    cells = F.array(F.struct(F.col("team_a").alias("team"), points_a.alias("points")),
                    F.struct(F.col("team_b").alias("team"), points_b.alias("points")))
    table = matches.select("group", F.inline(cells)).groupBy("group", "team").agg(F.sum("points").alias("points"))
    w = Window.partitionBy("group").orderBy(F.col("points").desc(), "team")
    return table.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top)


def dashboards(df: DataFrame, views: dict[str, tuple[Sequence[str], str | None, Column | None]]) -> DataFrame:
    """Many saved views in one pass: ``name -> (one or two dimensions, averaged measure, row condition)``.

    Each row turns into one cell per view, and the cells are counted and averaged map-side, so
    the table is read (and any join under it done) once however many views there are.
    """
    cells = []
    for name, (dims, measure, condition) in views.items():
        first, second = (*dims, None)[:2]
        cell = F.struct(
            F.lit(name).alias("view_name"), F.col(first).cast("string").alias("dim_1"),
            (F.col(second) if second else F.lit(None)).cast("string").alias("dim_2"),
            (F.col(measure) if measure else F.lit(None)).cast("double").alias("value"))
        cells.append(cell if condition is None else F.when(condition, cell))
    return df.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("view_name", "dim_1", "dim_2").agg(
        F.count("*").alias("n"), F.avg("value").alias("avg_value"))
