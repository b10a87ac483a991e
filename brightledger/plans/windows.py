"""Window functions, sorts and top-k (W*, T*)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from brightledger.operators import aggregates as agg
from brightledger.operators import joins, series
from brightledger.operators.ordering import with_position
from brightledger.plans.registry import query
from brightledger.plans.relations import _IDS, _TEAMS, team_scores
from brightledger.plans.view_sql import BOXES, OHLCV, TXN, with_views

NTZ = "timestamp_ntz"

def day():
    return F.col("day").cast("string").alias("day")


@query("w1_rank_ties_kept", with_views(TXN) + """, s AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, merchant_id, sum(commission_amount) AS total FROM txn GROUP BY 1, 2)
SELECT window_start, merchant_id, CAST(total AS BIGINT) AS total FROM (SELECT *, rank() OVER (PARTITION BY window_start ORDER BY total DESC) AS r FROM s) WHERE r = 1""")
def _(t):
    sums = t.txn.groupBy(F.window("ts", "6 hours").alias("w"), "merchant_id").agg(F.sum("commission_amount").alias("total"))
    ranked = sums.withColumn("r", F.rank().over(Window.partitionBy("w").orderBy(F.desc("total"))))
    return ranked.filter("r = 1").select(F.col("w.start").cast(NTZ).alias("window_start"), "merchant_id", "total")


@query("w2_trailing_row_mean", with_views(OHLCV) + """SELECT strftime(day, '%Y-%m-%d') AS day, round(CASE WHEN count(*) OVER w = 7 THEN avg(volume) OVER w END, 4) AS trailing_mean
FROM ohlcv WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def _(t):
    return series.trailing_row_mean(t.ohlcv.select("day", "volume"), ["day"], "volume").select(
        day(), F.round("trailing_mean", 4).alias("trailing_mean"))


@query("w3_lead_difference", with_views(OHLCV) + """SELECT * FROM (SELECT strftime(day, '%Y-%m-%d') AS day, round(lead("close", 5) OVER (ORDER BY day) - "close", 4) AS change FROM ohlcv)
WHERE change IS NOT NULL""")
def _(t):
    return series.lead_difference(t.ohlcv.select("day", "close"), ["day"], "close", 5).select(day(), F.round("change", 4).alias("change"))


@query("w4_lookback_windows", with_views(OHLCV) + """SELECT strftime(day, '%Y-%m-%d') AS day, target, CAST(n AS INTEGER) AS n, oldest, newest, round(mean_volume, 4) AS mean_volume FROM (
SELECT day, "close" AS target, count(*) OVER w AS n, first_value("open") OVER w AS oldest, last_value("open") OVER w AS newest, avg(volume) OVER w AS mean_volume
FROM ohlcv WINDOW w AS (ORDER BY day ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)) WHERE n = 60""")
def _(t):
    out = series.lookback_windows(t.ohlcv, ["day"], ["open", "high", "low", "close", "volume"], "close")
    mean = F.aggregate("window", F.lit(0.0), lambda s, r: s + r["volume"]) / 60
    return out.select(day(), "target", F.size("window").alias("n"), F.col("window")[0]["open"].alias("oldest"),
                      F.col("window")[59]["open"].alias("newest"), F.round(mean, 4).alias("mean_volume"))


@query("w5_calendar_range_mean", with_views(OHLCV) + """SELECT strftime(day, '%Y-%m-%d') AS day, round(avg(volume) OVER (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 4) AS range_mean FROM ohlcv""")
def _(t):
    out = joins.trailing_day_mean(t.ohlcv.select("day"), t.ohlcv, "day", "volume", 7, "range_mean")
    return out.select(day(), F.round("range_mean", 4).alias("range_mean"))


@query("w6_dense_index", _IDS + "SELECT 'user' AS kind, user_id AS id, user_idx AS idx FROM ui UNION ALL SELECT 'item', item_id, item_idx FROM ii")
def _(t):
    users = t.ratings.select("user_id").union(t.edges.select("src")).union(t.edges.select("dst")).distinct()
    ids = users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id")).union(
        t.ratings.select(F.lit("item"), "item_id").distinct())
    return with_position(ids, ["id"], by=["kind"])


@query("w7_latest_row", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def _(t):
    return joins.latest_per_key(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query("w8_top_n_per_group", "WITH " + _TEAMS + """ SELECT grp, team, score, place FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, team) AS place FROM teams) WHERE place <= 2""")
def _(t):
    w = Window.partitionBy("grp").orderBy(F.desc("score"), "team")
    return team_scores(t).withColumn("place", F.row_number().over(w)).filter("place <= 2")


@query("w9_chronological_split", with_views(OHLCV) + """, p AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM ohlcv)
SELECT strftime(day, '%Y-%m-%d') AS day, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM p""")
def _(t):
    return series.chronological_split(t.ohlcv.select("day"), ["day"]).select(day(), "split")


@query("w10_share_of_total", """SELECT user_id, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM events GROUP BY 1""")
def _(t):
    return agg.frequency(t.events, ["user_id"], "share").withColumn("share", F.round("share", 9))


@query("w11_row_names", with_views(BOXES) + """SELECT filename, box_id, 'plate_' || CASE WHEN i < 10000 THEN lpad(CAST(i AS VARCHAR), 4, '0') ELSE CAST(i AS VARCHAR) END AS row_name
FROM (SELECT filename, box_id, row_number() OVER (ORDER BY filename, box_id) - 1 AS i FROM boxes)""")
def _(t):
    return series.row_names(t.boxes.select("filename", "box_id"), ["filename", "box_id"])


@query("t1_sort_by_aggregate", with_views(TXN) + """SELECT merchant_category, CAST(sum(amount) AS BIGINT) AS total FROM txn GROUP BY 1 ORDER BY total DESC""")
def _(t):
    return t.txn.groupBy("merchant_category").agg(F.sum("amount").alias("total")).orderBy(F.desc("total"))


@query("t2_top_by_expression", with_views(BOXES) + """SELECT 'area' AS kind, * FROM (SELECT filename, box_id, (xmax - xmin) * (ymax - ymin) AS size FROM boxes ORDER BY size DESC, filename, box_id LIMIT 10)
UNION ALL SELECT 'reach', * FROM (SELECT filename, box_id, xmax * ymax AS size FROM boxes ORDER BY size DESC, filename, box_id LIMIT 10)""")
def _(t):
    def top(kind, expr):
        return t.boxes.select(F.lit(kind).alias("kind"), "filename", "box_id", F.expr(expr).alias("size")).orderBy(
            F.desc("size"), "filename", "box_id").limit(10)

    return top("area", "(xmax - xmin) * (ymax - ymin)").union(top("reach", "xmax * ymax"))


@query("t3_odd_shape_top", with_views(BOXES) + """, q AS (SELECT filename, box_id, (ymax - ymin) // nullif(xmax - xmin, 0) AS quotient FROM boxes)
SELECT * FROM q WHERE quotient < 0.5 ORDER BY abs(1.0 - quotient) DESC, filename, box_id LIMIT 10""")
def _(t):
    q = t.boxes.select("filename", "box_id", F.expr("(ymax - ymin) div nullif(xmax - xmin, 0)").alias("quotient"))
    return q.filter("quotient < 0.5").orderBy(F.abs(1.0 - F.col("quotient")).desc(), "filename", "box_id").limit(10)


@query("t4_top_by_frequency", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10")
def _(t):
    return agg.frequency(t.events, ["user_id"]).orderBy(F.desc("n"), "user_id").limit(10)


@query("t5_multi_key_sort", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 ORDER BY 1, 2")
def _(t):
    return agg.frequency(t.events, ["user_id", "event_type"]).orderBy("user_id", "event_type")
