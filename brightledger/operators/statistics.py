"""Intervals, tests, correlation and outlier fences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions import tails
from brightledger.operators.aggregates import to_long
from brightledger.operators.ordering import exact_quantiles, selected_quantiles
from brightledger.operators.rows import clip

Z95 = 1.96  # fixed value: two-sided 95 % normal quantile


def proportion_interval(p: Column, n: Column, z: float = Z95) -> dict[str, Column]:
    se = F.sqrt(p * (1 - p) / n)
    return {"se": se, "lower": p - z * se, "upper": p + z * se}


def spread_interval(p: Column, n: Column, z: float = Z95) -> dict[str, Column]:
    """Spread d = 2p - 1 with twice the standard error of p and a symmetric interval."""
    d, se = 2 * p - 1, 2 * F.sqrt(p * (1 - p) / n)
    return {"spread": d, "spread_se": se, "spread_lower": d - z * se, "spread_upper": d + z * se}


def spread_test(df: DataFrame) -> DataFrame:
    """Two-sided z-test of zero spread on rows with ``spread`` and ``spread_se``."""
    return df.withColumn("z", F.try_divide("spread", "spread_se")).withColumn("p_value", tails.normal_two_sided_p("z"))


def decision(p_value: Column, levels: Sequence[float] = (0.05, 0.1)) -> Column:
    """Label of the strictest level at which the null hypothesis is rejected."""
    out = F.when(F.lit(False), "")
    for level in sorted(levels):
        out = out.when(p_value < level, f"rejected at {level:g}")
    return out.otherwise("not rejected")


def _two_groups(df: DataFrame, group: str, a: str, b: str, metrics: Sequence[str]) -> DataFrame:
    return to_long(df.filter(F.col(group).isin(a, b)), metrics, [group]).filter(F.col("value").isNotNull())


def levene(df: DataFrame, group: str, a: str, b: str, metrics: Sequence[str]) -> DataFrame:
    """Median-centred test of equal variances of two groups, one row per metric."""
    long = _two_groups(df, group, a, b, metrics)
    medians = exact_quantiles(long, "value", {"med": 0.5}, [group, "column"])
    dev = long.join(F.broadcast(medians), [group, "column"]).select(  # two rows per metric
        group, "column", F.abs(F.col("value") - F.col("med")).alias("d"))
    per = dev.groupBy("column", group).agg(F.count("*").alias("n"), F.avg("d").alias("m"), F.var_pop("d").alias("v"))
    both = per.groupBy("column").agg(
        F.sum("n").alias("n_all"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m_all"),
        F.sum(F.col("n") * F.col("v")).alias("within"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("sq"))
    between = F.col("sq") - F.col("n_all") * F.col("m_all") * F.col("m_all")
    out = both.select("column", (between * (F.col("n_all") - 2) / F.col("within")).alias("statistic"),
                      F.lit(1.0).alias("df1"), (F.col("n_all") - 2).cast("double").alias("df2"))
    return out.withColumn("p_value", tails.f_upper_p("statistic", "df1", "df2"))


def t_test(df: DataFrame, group: str, a: str, b: str, metrics: Sequence[str], pooled: bool = True) -> DataFrame:
    """Two-sample two-sided t-test per metric; pooled or unequal variances."""
    long = _two_groups(df, group, a, b, metrics)

    def of(g, fn):
        return fn(F.when(F.col(group) == g, F.col("value")))

    s = long.groupBy("column").agg(*[of(g, fn).alias(f"{name}_{side}") for side, g in (("a", a), ("b", b))
                                     for name, fn in (("n", F.count), ("m", F.avg), ("v", F.var_samp))])
    na, nb, va, vb = (F.col(c) for c in ("n_a", "n_b", "v_a", "v_b"))
    if pooled:
        dof = (na + nb - 2).cast("double")
        se = F.sqrt(((na - 1) * va + (nb - 1) * vb) / dof * (1 / na + 1 / nb))
    else:
        ea, eb = va / na, vb / nb
        dof = F.pow(ea + eb, F.lit(2)) / (ea * ea / (na - 1) + eb * eb / (nb - 1))
        se = F.sqrt(ea + eb)
    out = s.select("column", ((F.col("m_a") - F.col("m_b")) / se).alias("t"), dof.alias("df"))
    return out.withColumn("p_value", tails.t_two_sided_p("t", "df"))


def _pairs(columns: Sequence[str], diagonal: bool):
    return [(x, y) for i, x in enumerate(columns) for y in columns[i if diagonal else i + 1:]]


def correlation_pairs(df: DataFrame, columns: Sequence[str], method=F.corr, name: str = "corr",
                      diagonal: bool = False) -> DataFrame:
    """One value per column pair (upper triangle), all pairs in one pass over the rows."""
    pairs = _pairs(columns, diagonal)
    one = df.agg(*[method(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"c{i}") for i, (x, y) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"c{i}").alias(name))
                      for i, (x, y) in enumerate(pairs)])
    return one.select(F.inline(cells))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full symmetric matrix in long form."""
    upper = correlation_pairs(df, columns, diagonal=True)
    lower = upper.filter("column_a <> column_b").select(
        F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "corr")
    return upper.unionByName(lower)


def correlated_above(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Pairs with absolute correlation above the threshold, strongest first."""
    return correlation_pairs(df, columns).withColumn("strength", F.abs("corr")).filter(
        F.col("strength") > threshold).orderBy(F.desc("strength"), "column_a", "column_b")


def mean_and_covariance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of every pair with the means of both columns."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("mean")) for c in columns])))
    cov = correlation_pairs(df, columns, F.covar_samp, "covariance", diagonal=True)
    a = means.select(F.col("column").alias("column_a"), F.col("mean").alias("mean_a"))
    b = means.select(F.col("column").alias("column_b"), F.col("mean").alias("mean_b"))
    return cov.join(F.broadcast(a), "column_a").join(F.broadcast(b), "column_b")  # one row per listed column


def outlier_fences(df: DataFrame, columns: Sequence[str], factor: float = 3.0) -> DataFrame:
    """Lower and upper fence per column: quartiles widened by ``factor`` times their distance."""
    q = selected_quantiles(df, columns, {"q1": 0.25, "q3": 0.75})
    reach = factor * (F.col("q3") - F.col("q1"))
    return q.select("column", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper"))


def clip_to_fences(df: DataFrame, fences: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clip with fences learned elsewhere; the fences enter as a one-row map."""
    m = fences.agg(F.map_from_entries(F.collect_list(F.struct(
        "column", F.struct("lower", "upper")))).alias("m")).scalar()  # one entry per listed column
    out = df.withColumn("_f", m)
    return out.withColumns({c: clip(F.col(c), F.col("_f")[c]["lower"], F.col("_f")[c]["upper"]) for c in columns}).drop("_f")


def mean_and_standard_error(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.count(value).alias("n"),
                               (F.stddev_pop(value) / F.sqrt(F.count(value))).alias("standard_error"))


def chance_above_zero(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Normal approximation of P(sum of the group's values > 0) from mean and variance."""
    s = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var"))
    z = -(F.col("n") * F.col("mean")) / F.sqrt(F.col("n") * F.col("var"))
    return s.withColumn("z", z).withColumn("p_above", tails.normal_upper_p("z"))
