"""Statistics and tests (Q*)."""

from pyspark.sql import functions as F

from brightledger.operators import statistics as st
from brightledger.plans.registry import query
from brightledger.plans.view_sql import POLLS, with_views, normal_upper_sql

COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("q1_proportion_interval", with_views(POLLS) + """SELECT strftime(day, '%Y-%m-%d') AS day, pollster, round(se, 6) AS se, round(p - 1.96::DOUBLE * se, 6) AS lower, round(p + 1.96::DOUBLE * se, 6) AS upper
FROM (SELECT *, pct_f / 100 AS p, sqrt(pct_f / 100 * (1 - pct_f / 100) / n) AS se FROM polls)""")
def _(t):
    c = st.proportion_interval(F.col("pct_f") / 100, F.col("n"))
    return rounded(t.polls.select(F.col("day").cast("string").alias("day"), "pollster", *[v.alias(k) for k, v in c.items()]),
                   "se", "lower", "upper")


_POOLED = with_views(POLLS) + ", s AS (SELECT CAST(sum(n) AS BIGINT) AS n, sum(pct_f * n / 100) / sum(n) AS p FROM polls) "


def pooled(t):
    return t.polls.agg(F.sum("n").alias("n"), (F.sum(F.col("pct_f") * F.col("n") / 100) / F.sum("n")).alias("p"))


@query("q2_pooled_interval", _POOLED + """SELECT n, round(p, 6) AS p, round(sqrt(p * (1 - p) / n), 6) AS se, round(p - 1.96::DOUBLE * sqrt(p * (1 - p) / n), 6) AS lower,
round(p + 1.96::DOUBLE * sqrt(p * (1 - p) / n), 6) AS upper FROM s""")
def _(t):
    return rounded(pooled(t).withColumns(st.proportion_interval(F.col("p"), F.col("n"))), "p", "se", "lower", "upper")


@query("q3_spread_interval", _POOLED + """SELECT round(2 * p - 1, 6) AS spread, round(2 * sqrt(p * (1 - p) / n), 6) AS spread_se,
round(2 * p - 1 - 1.96::DOUBLE * 2 * sqrt(p * (1 - p) / n), 6) AS spread_lower, round(2 * p - 1 + 1.96::DOUBLE * 2 * sqrt(p * (1 - p) / n), 6) AS spread_upper FROM s""")
def _(t):
    out = pooled(t).withColumns(st.spread_interval(F.col("p"), F.col("n"))).drop("n", "p")
    return rounded(out, *out.columns)


@query("q4_spread_z", _POOLED + "SELECT round((2 * p - 1) / (2 * sqrt(p * (1 - p) / n)), 6) AS z FROM s")
def _(t):
    out = st.spread_test(pooled(t).withColumns(st.spread_interval(F.col("p"), F.col("n"))))
    return rounded(out.select("z"), "z")


@query("q4_spread_test", _POOLED + ", x AS (SELECT (2 * p - 1) / (2 * sqrt(p * (1 - p) / n)) AS z FROM s), y AS (SELECT z, 2 * " + normal_upper_sql("abs(z)") + """ AS p_value FROM x)
SELECT round(z, 6) AS z, round(p_value, 6) AS p_value, CASE WHEN p_value < 0.05 THEN 'rejected at 0.05' WHEN p_value < 0.1 THEN 'rejected at 0.1' ELSE 'not rejected' END AS decision FROM y""")
def _(t):
    out = st.spread_test(pooled(t).withColumns(st.spread_interval(F.col("p"), F.col("n"))))
    return rounded(out.withColumn("decision", st.decision(F.col("p_value"))).select("z", "p_value", "decision"), "z", "p_value")


_LEVENE = """SELECT '{c}' AS "column", round((sq - n_all * m_all * m_all) * (n_all - 2) / within_ss, 4) AS statistic, CAST(n_all - 2 AS DOUBLE) AS df2 FROM (
SELECT CAST(sum(n) AS BIGINT) AS n_all, sum(n * m) / sum(n) AS m_all, sum(n * v) AS within_ss, sum(n * m * m) AS sq FROM (
SELECT l_returnflag, count(*) AS n, avg(d) AS m, var_pop(d) AS v FROM (SELECT l_returnflag, abs({c} - quantile_cont({c}, 0.5) OVER (PARTITION BY l_returnflag)) AS d
FROM lineitem WHERE l_returnflag IN ('A', 'R')) GROUP BY 1))"""


@query("q5_equal_variances", " UNION ALL ".join(_LEVENE.format(c=c) for c in ("l_quantity", "l_extendedprice")))
def _(t):
    out = st.levene(t.lineitem, "l_returnflag", "A", "R", ["l_quantity", "l_extendedprice"])
    return rounded(out.select("column", "statistic", "df2"), "statistic", digits=4)


_T = """SELECT '{c}' AS "column", '{kind}' AS kind, round((ma - mb) / {se}, 6) AS t, round({df}, 4) AS df FROM (SELECT
avg({c}) FILTER (l_returnflag = 'A') AS ma, avg({c}) FILTER (l_returnflag = 'R') AS mb, var_samp({c}) FILTER (l_returnflag = 'A') AS va, var_samp({c}) FILTER (l_returnflag = 'R') AS vb,
CAST(count({c}) FILTER (l_returnflag = 'A') AS DOUBLE) AS na, CAST(count({c}) FILTER (l_returnflag = 'R') AS DOUBLE) AS nb FROM lineitem)"""
_T_POOLED = {"se": "sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb))", "df": "na + nb - 2", "kind": "pooled"}
_T_WELCH = {"se": "sqrt(va / na + vb / nb)", "kind": "unequal",
            "df": "pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1))"}


@query("q6_t_test", " UNION ALL ".join(_T.format(c=c, **k) for c in ("l_quantity", "l_extendedprice") for k in (_T_POOLED, _T_WELCH)))
def _(t):
    m = ["l_quantity", "l_extendedprice"]
    a = st.t_test(t.lineitem, "l_returnflag", "A", "R", m, True).withColumn("kind", F.lit("pooled"))
    b = st.t_test(t.lineitem, "l_returnflag", "A", "R", m, False).withColumn("kind", F.lit("unequal"))
    return a.unionByName(b).select("column", "kind", F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


@query("q7_test_decisions")
def _(t):
    m = ["l_quantity", "l_extendedprice", "l_discount"]
    a = st.t_test(t.lineitem, "l_returnflag", "A", "R", m).select("column", F.lit("means").alias("test"), "p_value")
    b = st.levene(t.lineitem, "l_returnflag", "A", "R", m).select("column", F.lit("variances").alias("test"), "p_value")
    return a.unionByName(b).withColumn("decision", st.decision(F.col("p_value")))


def _critical(level_z):
    """Two-sided critical value of Student's distribution by its expansion in 1 / df, exact to six digits from df = 100 on."""
    z, d = level_z, "df"
    return f"({z}::DOUBLE + {z ** 3 + z} / (4 * {d}) + {5 * z ** 5 + 16 * z ** 3 + 3 * z} / (96 * {d} * {d}))"


# fixed values: normal quantiles at 0.975 and 0.95
_REJECTED = {"rejected at 0.05": 1.959963984540054, "rejected at 0.1": 1.6448536269514722}
_TESTED = ("l_quantity", "l_extendedprice", "l_discount")


@query("q7_decisions", f"""WITH s AS (SELECT "column", 'means' AS test, abs(t) AS t, df FROM ({" UNION ALL ".join(_T.format(c=c, **_T_POOLED) for c in _TESTED)})
UNION ALL SELECT "column", 'variances', sqrt(greatest(statistic, 0)), df2 FROM ({" UNION ALL ".join(_LEVENE.format(c=c) for c in _TESTED)}))
SELECT "column", test, CASE {" ".join(f"WHEN t > {_critical(z)} THEN '{name}'" for name, z in _REJECTED.items())} ELSE 'not rejected' END AS decision FROM s""")
def _(t):
    """Decisions alone: they follow from critical values as well."""
    means = st.t_test(t.lineitem, "l_returnflag", "A", "R", _TESTED).select("column", F.lit("means").alias("test"), "p_value")
    variances = st.levene(t.lineitem, "l_returnflag", "A", "R", _TESTED).select("column", F.lit("variances").alias("test"), "p_value")
    return means.unionByName(variances).select("column", "test", st.decision(F.col("p_value")).alias("decision"))


@query("q8_yes_no_mean", "SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 6) AS rate FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)), 6).alias("rate"))


def _pair_sql(fn, name, diagonal):
    pairs = [(a, b) for i, a in enumerate(COLUMNS) for b in COLUMNS[i if diagonal else i + 1:]]
    return " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {fn}({a}, {b}) AS {name} FROM lineitem" for a, b in pairs)


@query("q9_correlation_matrix", f"WITH u AS ({_pair_sql('corr', 'c', True)}) SELECT column_a, column_b, round(c, 6) AS corr FROM u UNION ALL SELECT column_b, column_a, round(c, 6) FROM u WHERE column_a <> column_b")
def _(t):
    return rounded(st.correlation_matrix(t.lineitem, COLUMNS), "corr")


@query("q10_correlated_pairs", f"WITH u AS ({_pair_sql('corr', 'c', False)}) SELECT column_a, column_b, round(c, 6) AS corr, round(abs(c), 6) AS strength FROM u WHERE abs(c) > 0.003")
def _(t):
    return rounded(st.correlated_above(t.lineitem, COLUMNS, 0.003), "corr", "strength")


@query("q11_covariance", f"""WITH u AS ({_pair_sql('covar_samp', 'c', True)}), m AS ({' UNION ALL '.join(f"SELECT '{c}' AS k, avg({c}) AS v FROM lineitem" for c in COLUMNS)})
SELECT column_a, column_b, round(c, 4) AS covariance, round(a.v, 6) AS mean_a, round(b.v, 6) AS mean_b FROM u JOIN m a ON a.k = column_a JOIN m b ON b.k = column_b""")
def _(t):
    return rounded(st.mean_and_covariance(t.lineitem, COLUMNS), "mean_a", "mean_b").withColumn("covariance", F.round("covariance", 4))


@query("q12_outlier_fences", """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(greatest(least(l_extendedprice, q3 + 0.3::DOUBLE * (q3 - q1)), q1 - 0.3::DOUBLE * (q3 - q1)), 6) AS price FROM lineitem, q""")
def _(t):
    fences = st.outlier_fences(t.lineitem.filter("l_shipdate < timestamp'1996-01-01'"), ["l_extendedprice"], 0.3)
    out = st.clip_to_fences(t.lineitem, fences, ["l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("l_extendedprice", 6).alias("price"))


@query("q13_standard_error", """SELECT l_linenumber, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity) / sqrt(count(*)), 6) AS standard_error FROM lineitem GROUP BY 1""")
def _(t):
    return rounded(st.mean_and_standard_error(t.lineitem, ["l_linenumber"], "l_quantity"), "mean", "standard_error")


@query("q14_tail_z", """SELECT l_linenumber, round(-(count(*) * avg(l_quantity - 25.5::DOUBLE)) / sqrt(count(*) * var_pop(l_quantity - 25.5::DOUBLE)), 6) AS z FROM lineitem GROUP BY 1""")
def _(t):
    out = st.chance_above_zero(t.lineitem.withColumn("gain", F.col("l_quantity") - 25.5), ["l_linenumber"], "gain")
    return rounded(out.select("l_linenumber", "z"), "z")


@query("q14_chance_above_zero", """WITH x AS (SELECT l_linenumber, -(count(*) * avg(l_quantity - 25.5::DOUBLE)) / sqrt(count(*) * var_pop(l_quantity - 25.5::DOUBLE)) AS z FROM lineitem GROUP BY 1)
SELECT l_linenumber, round(z, 6) AS z, round(""" + normal_upper_sql("z") + """, 6) AS p_above FROM x""")
def _(t):
    out = st.chance_above_zero(t.lineitem.withColumn("gain", F.col("l_quantity") - 25.5), ["l_linenumber"], "gain")
    return rounded(out.select("l_linenumber", "z", "p_above"), "z", "p_above")
