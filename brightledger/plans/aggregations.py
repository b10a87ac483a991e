"""Group aggregates, frequency tables, reports and dashboards (A*)."""

from pyspark.sql import functions as F

from brightledger.functions import dates
from brightledger.operators import aggregates as agg
from brightledger.operators import joins
from brightledger.plans.registry import query
from brightledger.plans.relations import _TEAMS, team_scores
from brightledger.plans.view_sql import EDGES, GAPS, POLLS, TXN, with_views


def r6(c, alias):
    return F.round(c, 6).alias(alias)


@query("a1_category_commission", with_views(TXN) + """SELECT merchant_category, CAST(sum(amount) AS BIGINT) AS total_amount,
round(avg(amount), 6) AS avg_amount, count(*) AS n_txn, CAST(sum(commission_amount) AS BIGINT) AS total_commission,
count(*) FILTER (commission_type = 'flat') AS n_flat, count(*) FILTER (commission_type = 'progressive') AS n_progressive,
count(*) FILTER (commission_type = 'tiered') AS n_tiered,
round(sum(commission_amount) / sum(amount)::DOUBLE, 9) AS commission_ratio FROM txn WHERE status = 'approved' GROUP BY 1""")
def _(t):
    return agg.category_commission(t.txn.filter("status = 'approved'")).withColumns({
        "avg_amount": F.round("avg_amount", 6), "commission_ratio": F.round("commission_ratio", 9)})


@query("a3_hour_counts", """SELECT hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, hour LIMIT 5""")
def _(t):
    return t.events.groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "hour").limit(5)


@query("a4_customer_totals", with_views(TXN) + """SELECT customer_id, count(*) AS n, CAST(sum(amount) AS BIGINT) AS total FROM txn GROUP BY 1""")
def _(t):
    return agg.counts_and_sums(t.txn, ["customer_id"], "amount").orderBy(F.desc("total"), "customer_id")


@query("a5_part_of_day_counts", """SELECT CASE WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'Morning' WHEN hour(ts) >= 12 AND hour(ts) < 18
THEN 'Afternoon' WHEN hour(ts) >= 18 THEN 'Evening' ELSE 'Night' END AS time_of_day, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy(dates.part_of_day(F.hour("ts")).alias("time_of_day")).agg(F.count("*").alias("n"))


@query("a6_hour_minute_totals", with_views(TXN) + """SELECT hour(ts) AS hour, minute(ts) AS minute, count(*) AS n, CAST(sum(amount) AS BIGINT) AS total
FROM txn GROUP BY 1, 2""")
def _(t):
    return agg.counts_and_sums(t.txn, [F.hour("ts").alias("hour"), F.minute("ts").alias("minute")], "amount").orderBy("hour", "minute")


@query("a7_document_group", with_views(TXN) + """SELECT 'category' AS facet, merchant_category AS key, count(*) AS n, CAST(sum(amount) AS BIGINT) AS total FROM txn
WHERE status = 'approved' GROUP BY 2 UNION ALL SELECT 'customer_type', customer_type, count(*), CAST(sum(amount) AS BIGINT) FROM txn
WHERE status = 'approved' GROUP BY 2""")
def _(t):
    approved = t.txn.filter("status = 'approved'")
    a = agg.counts_and_sums(approved, [F.col("merchant_category").alias("key")], "amount")
    b = agg.counts_and_sums(approved, [F.col("customer_type").alias("key")], "amount")
    return a.select(F.lit("category").alias("facet"), "*").union(b.select(F.lit("customer_type"), "*")).orderBy(
        "facet", F.desc("total"))


@query("a8_hour_label_group", with_views(TXN) + """SELECT strftime(ts, '%H:00') AS hour, count(*) AS n, CAST(sum(amount) AS BIGINT) AS total FROM txn GROUP BY 1""")
def _(t):
    return agg.counts_and_sums(t.txn, [dates.hour_label(F.col("ts")).alias("hour")], "amount").orderBy("hour")


@query("a9_category_hour_group", with_views(TXN) + """SELECT merchant_category, strftime(ts, '%H:00') AS hour, count(*) AS n,
CAST(sum(amount) AS BIGINT) AS total FROM txn GROUP BY 1, 2""")
def _(t):
    return agg.counts_and_sums(t.txn, ["merchant_category", dates.hour_label(F.col("ts")).alias("hour")], "amount")


@query("a10_frequency", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return agg.frequency(t.events, ["event_type"])


@query("a11_relative_frequency", "SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM events), 6) AS pct FROM events GROUP BY 1")
def _(t):
    return agg.frequency(t.events, ["event_type"], "pct", 100.0).withColumn("pct", F.round("pct", 6))


@query("a12_conditional_frequency", """WITH s AS (SELECT * FROM events WHERE value > 20)
SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM s)::DOUBLE, 6) AS share FROM s GROUP BY 1""")
def _(t):
    return agg.frequency(t.events.filter("value > 20"), ["event_type"], "share").withColumn("share", F.round("share", 6))


@query("a13_count_spread", """SELECT round(avg(n), 6) AS mean_count, round(var_samp(n), 6) AS var_count
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""")
def _(t):
    return agg.spread_of_counts(t.events, "user_id").select(r6("mean_count", "mean_count"), r6("var_count", "var_count"))


@query("a14_user_growth", """SELECT hour(first_ts) AS hour, count(*) AS new_users FROM (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY 1) GROUP BY 1""")
def _(t):
    return t.events.groupBy("user_id").agg(F.min("ts").alias("first_ts")).groupBy(F.hour("first_ts").alias("hour")).agg(
        F.count("*").alias("new_users"))


@query("a15_global_shares", with_views(POLLS) + """SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(pct_f * n / 100) / sum(n), 6) AS share_f,
round(sum(pct_o * n / 100) / sum(n), 6) AS share_o FROM polls""")
def _(t):
    w = lambda c: F.sum(F.col(c) * F.col("n") / 100) / F.sum("n")
    return t.polls.agg(F.sum("n").alias("n"), r6(w("pct_f"), "share_f"), r6(w("pct_o"), "share_o"))


@query("a16_weighted_daily_mean", with_views(POLLS) + """SELECT strftime(day, '%Y-%m-%d') AS day, CAST(sum(n) AS BIGINT) AS n,
round(sum(pct_f * n / 100) / sum(n), 6) AS share_f, round(sum(pct_o * n / 100) / sum(n), 6) AS share_o FROM polls GROUP BY 1""")
def _(t):
    w = lambda c: F.sum(F.col(c) * F.col("n") / 100) / F.sum("n")
    return t.polls.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.sum("n").alias("n"), r6(w("pct_f"), "share_f"), r6(w("pct_o"), "share_o"))


_DESCRIBE = """SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS "min", max({c}) AS "max",
round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3 FROM lineitem"""


@query("a17_describe", " UNION ALL ".join(_DESCRIBE.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    d = agg.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return d.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q1", "median", "q3")})


_MATRIX = """SELECT l_returnflag, '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS "min",
max({c}) AS "max", count({c}) AS n FROM lineitem GROUP BY 1"""


@query("a18_group_matrix", " UNION ALL ".join(_MATRIX.format(c=c) for c in ("l_quantity", "l_extendedprice")))
def _(t):
    return agg.group_matrix(t.lineitem, "l_returnflag", ["l_quantity", "l_extendedprice"]).withColumns(
        {c: F.round(c, 6) for c in ("mean", "std")})


_MISSING = """SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_missing, '{d}' AS dtype,
round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*), 6) AS pct_missing FROM gaps HAVING n_missing > 0"""


@query("a19_missing_report", with_views(GAPS) + " UNION ALL ".join(_MISSING.format(c=c, d=d) for c, d in (
    ("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"))))
def _(t):
    return agg.missing_report(t.events_with_gaps).withColumn("pct_missing", F.round("pct_missing", 6)).orderBy(
        F.desc("n_missing"), "column")


@query("a20_rate_by_missingness", with_views(GAPS) + """SELECT CASE WHEN event_type IS NULL THEN 1 ELSE 0 END AS is_missing, count(*) AS n,
round(avg(value), 6) AS mean_value FROM gaps GROUP BY 1""")
def _(t):
    return t.events_with_gaps.groupBy(F.isnull("event_type").cast("int").alias("is_missing")).agg(
        F.count("*").alias("n"), r6(F.avg("value"), "mean_value"))


@query("a21_distinct_counts", "SELECT event_type, count(DISTINCT user_id) AS n_users, count(*) AS n FROM events GROUP BY 1")
def _(t):
    # one row per (type, user) first, so a hot type is counted in parallel
    per_user = t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return per_user.groupBy("event_type").agg(F.count("user_id").alias("n_users"), F.sum("n").alias("n"))


@query("a22_first_row_per_key", """SELECT o_custkey, min_by(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderkey,
min_by(o_totalprice, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_totalprice FROM orders GROUP BY 1""")
def _(t):
    return joins.first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query("a22_distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").dropDuplicates()


@query("a23_exact_quantiles", """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3,
round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY 1""")
def _(t):
    out = agg.exact_quantiles(t.lineitem, "l_extendedprice", {"q1": 0.25, "q3": 0.75, "p99": 0.99}, ["l_returnflag"])
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "q3", "p99")})


@query("a24_length_mean_median", """SELECT lang, round(avg(length(text)), 6) AS mean_length, round(quantile_cont(length(text), 0.5), 6) AS median_length
FROM documents GROUP BY 1""")
def _(t):
    lengths = t.documents.select("lang", F.length("text").alias("len"))
    means = lengths.groupBy("lang").agg(r6(F.avg("len"), "mean_length"))
    return means.join(agg.exact_quantiles(lengths, "len", {"median_length": 0.5}, ["lang"]), "lang")


@query("a25_box_plot", """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l_returnflag, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
min(l_extendedprice) AS whisker_low, max(l_extendedprice) AS whisker_high FROM lineitem JOIN q USING (l_returnflag)
WHERE l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1""")
def _(t):
    return agg.box_plot(t.lineitem, "l_extendedprice", ["l_returnflag"]).withColumns(
        {c: F.round(c, 6) for c in ("q1", "median", "q3")})


_HIST = """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS total FROM lineitem),
v AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 50)) AS INTEGER) + 1, 50) AS bin, lo, hi, total FROM lineitem, b)
SELECT bin, count(*) AS n, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 50, 6) AS lower,
round(count(*) / (any_value(total) * (any_value(hi) - any_value(lo)) / 50), 12) AS density FROM v GROUP BY bin"""


@query("a26_histogram", _HIST)
def _(t):
    return agg.histogram(t.lineitem, "l_extendedprice", 50, density=True).withColumns(
        {"lower": F.round("lower", 6), "density": F.round("density", 12)})


@query("a27_kernel_density", """WITH s AS (SELECT count(*) AS n, stddev_samp(p_retailprice) * pow(count(*), -0.2::DOUBLE) AS h, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
g AS (SELECT i AS point, lo - 3 * h + i * (hi - lo + 6 * h) / 49 AS x, h, n FROM s, (SELECT unnest(generate_series(0, 49)) AS i))
SELECT CAST(point AS INTEGER) AS point, round(x, 6) AS x, round(sum(exp(-0.5::DOUBLE * pow((p_retailprice - x) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 9) AS density
FROM g, part GROUP BY point, x""")
def _(t):
    return agg.kernel_density(t.part, "p_retailprice").select("point", r6("x", "x"), F.round("density", 9).alias("density"))


@query("a28_crosstab", """SELECT event_type, count(*) FILTER (isodow(ts) = 1) AS day_0, count(*) FILTER (isodow(ts) = 2) AS day_1, count(*) FILTER (isodow(ts) = 3) AS day_2,
count(*) FILTER (isodow(ts) = 4) AS day_3, count(*) FILTER (isodow(ts) = 5) AS day_4, count(*) FILTER (isodow(ts) = 6) AS day_5, count(*) FILTER (isodow(ts) = 7) AS day_6
FROM events GROUP BY 1""")
def _(t):
    return agg.crosstab(t.events.withColumn("weekday", F.weekday("ts")), "event_type", "weekday", range(7), "day_")


@query("a29_mode_imputation", with_views(GAPS) + """, m AS (SELECT event_type AS v FROM gaps WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT event_id, coalesce(event_type, (SELECT v FROM m)) AS event_type FROM gaps""")
def _(t):
    g = t.events_with_gaps
    fill = agg.most_frequent(g, "event_type").scalar()
    return g.select("event_id", F.coalesce("event_type", fill).alias("event_type"))


@query("a30_target_means", """SELECT o_orderkey, round(e, 6) AS encoded FROM orders JOIN (SELECT o_orderpriority,
avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END) AS e FROM orders GROUP BY 1) USING (o_orderpriority)""")
def _(t):
    labelled = t.orders.select("o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return agg.target_means(labelled, "o_orderpriority", "label").select("o_orderkey", r6("encoded", "encoded"))


@query("a31_class_weights", """SELECT round(count(*) FILTER (quality = 0) / (count(*) FILTER (quality = 1))::DOUBLE, 6) AS pos_weight,
round(count(*) / (2.0::DOUBLE * count(*) FILTER (quality = 0)), 6) AS weight_0, round(count(*) / (2.0::DOUBLE * count(*) FILTER (quality = 1)), 6) AS weight_1 FROM labels""")
def _(t):
    return agg.class_weights(t.labels, "quality").select(*[r6(c, c) for c in ("pos_weight", "weight_0", "weight_1")])


@query("a32_wins_by_role", with_views(EDGES) + """, r AS (SELECT src AS team, CASE WHEN weight = 1 THEN 1 ELSE 0 END AS win FROM edges
UNION ALL SELECT dst, CASE WHEN weight = 3 THEN 1 ELSE 0 END FROM edges)
SELECT team, CAST(sum(win) AS BIGINT) AS wins, count(*) AS played FROM r GROUP BY 1""")
def _(t):
    home = t.edges.select(F.col("src").alias("team"), (F.col("weight") == 1).cast("int").alias("win"))
    away = t.edges.select(F.col("dst").alias("team"), (F.col("weight") == 3).cast("int").alias("win"))
    return home.unionByName(away).groupBy("team").agg(F.sum("win").alias("wins"), F.count("*").alias("played"))


@query("a33_standings", "WITH " + _TEAMS + """, pairs AS (SELECT a.grp, a.team AS ta, b.team AS tb, a.score // 10 AS sa, b.score // 10 AS sb FROM teams a JOIN teams b ON a.grp = b.grp AND a.team < b.team),
p AS (SELECT grp, ta AS team, CASE WHEN sa > sb THEN 3 WHEN sa = sb THEN 1 ELSE 0 END AS pts FROM pairs
UNION ALL SELECT grp, tb, CASE WHEN sb > sa THEN 3 WHEN sa = sb THEN 1 ELSE 0 END FROM pairs),
s AS (SELECT grp, team, CAST(sum(pts) AS BIGINT) AS points FROM p GROUP BY 1, 2)
SELECT grp AS "group", team, points, place FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY points DESC, team) AS place FROM s) WHERE place <= 2""")
def _(t):
    pairs = joins.group_pairs(team_scores(t).withColumn("score", F.expr("score div 10")), "grp", "team", ["score"])
    return agg.standings(pairs.withColumnRenamed("grp", "group"))


@query("a34_degrees", with_views(EDGES) + """SELECT 'out' AS side, src AS node, count(*) AS degree FROM edges GROUP BY 2 UNION ALL SELECT 'in', dst, count(*) FROM edges GROUP BY 2""")
def _(t):
    out = agg.frequency(t.edges.select(F.col("src").alias("node")), ["node"]).select(F.lit("out").alias("side"), "node", F.col("n").alias("degree"))
    into = agg.frequency(t.edges.select(F.col("dst").alias("node")), ["node"]).select(F.lit("in"), "node", "n")
    return out.union(into)


@query("a35_neighbour_lists", with_views(EDGES) + """SELECT src AS node, dst AS neighbour, n AS list_size FROM edges
JOIN (SELECT src, count(*) AS n FROM edges GROUP BY 1) USING (src) WHERE n >= 2""")
def _(t):
    from brightledger.operators.graph import neighbour_lists
    return neighbour_lists(t.edges, at_least=2)


@query("a36_single_box_share", """SELECT n AS boxes, count(*) AS images, round(count(*) / (SELECT count(DISTINCT l_orderkey) FROM lineitem)::DOUBLE, 6) AS share
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1""")
def _(t):
    per_image = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("boxes"))
    out = agg.frequency(per_image, ["boxes"], "share")
    return out.select("boxes", F.col("n").alias("images"), r6("share", "share"))


# --- dashboards: twenty-two saved views over the orders-with-customer table ----------------------------

# View name -> (dimensions, averaged measure or None, only a listed set of priorities).
DASHBOARD_VIEWS = {
    "size_by_stage": (["stage"], "tumor_size", False),
    "birth_year_counts": (["birth_year"], None, False),
    "label_by_type": (["cancer_type"], "label", False),
    "label_and_count_by_drug": (["drug"], "label", False),
    "count_by_therapy_and_drug": (["therapy", "drug"], None, False),
    "label_by_family": (["family"], "label", False),
    "label_by_therapy": (["therapy"], "label", False),
    "label_by_insurance": (["insurance"], "label", False),
    "count_by_insurance_and_stage": (["insurance", "stage"], None, False),
    "label_by_sessions": (["sessions"], "label", False),
    "label_by_job": (["job"], "label", False),
    "label_by_stage": (["stage"], "label", False),
    "label_by_symptom": (["symptom"], "label", False),
    "label_by_smoking": (["smoking"], "label", False),
    "stage_counts_for_symptoms": (["stage"], None, True),
    "count_by_job_and_stage": (["job", "stage"], None, False),
    "count_by_symptom_and_stage": (["symptom", "stage"], None, False),
    "label_by_size": (["tumor_size"], "label", False),
    "label_by_type_sorted": (["cancer_type"], "label", False),
    "count_by_symptom_and_type": (["symptom", "cancer_type"], None, False),
    "label_by_area": (["area"], "label", False),
    "birth_year_counts_annotated": (["birth_year"], None, False),
}

_PATIENTS = """patients AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, year(o_orderdate) AS birth_year,
 o_orderpriority AS symptom, o_orderkey % 4 + 1 AS stage, c_mktsegment AS cancer_type, c_nationkey AS job, c_custkey % 3 AS insurance,
 c_custkey % 2 AS family, o_orderkey % 5 AS drug, o_custkey % 2 AS therapy, o_orderkey % 7 AS sessions, c_custkey % 4 AS smoking,
 CAST(floor(o_totalprice / 50000) AS BIGINT) AS tumor_size, CASE WHEN c_nationkey < 12 THEN 'urban' ELSE 'rural' END AS area
 FROM orders JOIN customer ON o_custkey = c_custkey)"""


def patients(t):
    c = F.col
    return t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select(
        "o_orderkey", (c("o_orderstatus") == "F").cast("int").alias("label"), F.year("o_orderdate").alias("birth_year"),
        c("o_orderpriority").alias("symptom"), (c("o_orderkey") % 4 + 1).alias("stage"), c("c_mktsegment").alias("cancer_type"),
        c("c_nationkey").alias("job"), (c("c_custkey") % 3).alias("insurance"), (c("c_custkey") % 2).alias("family"),
        (c("o_orderkey") % 5).alias("drug"), (c("o_custkey") % 2).alias("therapy"), (c("o_orderkey") % 7).alias("sessions"),
        (c("c_custkey") % 4).alias("smoking"), F.floor(c("o_totalprice") / 50000).alias("tumor_size"),
        F.when(c("c_nationkey") < 12, "urban").otherwise("rural").alias("area"))


_LISTED = ("1-URGENT", "2-HIGH", "5-LOW")


def _dashboard_sql(name, dims, measure, listed):
    d = [f"CAST({x} AS VARCHAR)" for x in dims] + (["NULL"] if len(dims) == 1 else [])
    m = f"round(avg({measure}), 6)" if measure else "CAST(NULL AS DOUBLE)"
    where = " WHERE symptom IN ('1-URGENT', '2-HIGH', '5-LOW')" if listed else ""
    return f"SELECT '{name}' AS view_name, {d[0]} AS dim_1, {d[1]} AS dim_2, count(*) AS n, {m} AS avg_value FROM patients{where} GROUP BY {', '.join(dims)}"


@query("a37_dashboards", "WITH " + _PATIENTS + " " + " UNION ALL ".join(_dashboard_sql(n, *s) for n, s in DASHBOARD_VIEWS.items()))
def _(t):
    views = {name: (dims, measure, F.col("symptom").isin(*_LISTED) if listed else None)
             for name, (dims, measure, listed) in DASHBOARD_VIEWS.items()}
    return agg.dashboards(patients(t), views).withColumn("avg_value", F.round("avg_value", 6))
