"""Joins and set operations (J*, U*)."""

from pyspark.sql import functions as F

from brightledger.operators import joins, skew
from brightledger.operators.ordering import with_position
from brightledger.plans.registry import query
from brightledger.plans.view_sql import BOXES, EDGES, GAPS, OHLCV, PRED, RATINGS, TXN, with_views
from brightledger.session import materialise
from brightledger.sources.views import predicted_boxes


def r6(c, alias):
    return F.round(c, 6).alias(alias)


@query("j1_inner_join", """SELECT o_orderpriority, count(*) AS n, round(sum(l_extendedprice), 2) AS total
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def _(t):
    # lines are summed per order before the shuffle, so a hot order key arrives combined
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("s"))
    return t.orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderpriority").agg(
        F.sum("n").alias("n"), F.round(F.sum("s"), 2).alias("total"))


@query("j1_row_level_join", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderpriority
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return skew.salted_join(lines, orders, ["l_orderkey"])


@query("j2_suffix_merge", """SELECT d.doc_id, d.n_chars AS score_ocr, l.quality AS score_gt FROM documents d JOIN labels l USING (doc_id)""")
def _(t):
    a = t.documents.select("doc_id", F.col("n_chars").alias("score_ocr"))
    b = t.labels.select("doc_id", F.col("quality").alias("score_gt"))
    return a.join(b, "doc_id")


@query("j3_label_feature_merge", """SELECT doc_id, quality, toxic, lang, n_chars FROM labels JOIN documents USING (doc_id)""")
def _(t):
    return t.labels.join(t.documents.select("doc_id", "lang", "n_chars"), "doc_id")


@query("j4_above_average", with_views(TXN) + """, a AS (SELECT customer_id, avg(amount) AS average_amount FROM txn GROUP BY 1)
SELECT transaction_id, customer_id, amount FROM txn JOIN a USING (customer_id) WHERE amount > average_amount * 5""")
def _(t):
    averages = t.txn.groupBy("customer_id").agg(F.avg("amount").alias("average_amount"))
    return joins.above_average(t.txn, averages, "customer_id", 5).select("transaction_id", "customer_id", "amount")


@query("j5_interval_pairs", """WITH e AS (SELECT event_id, user_id, epoch_ms(date_trunc('second', ts)) // 1000 AS s FROM events)
SELECT a.user_id, a.event_id AS event_id_1, b.event_id AS event_id_2, b.s - a.s AS gap_seconds
FROM e a JOIN e b ON a.user_id = b.user_id AND b.s - a.s > 0 AND b.s - a.s <= 21600""")
def _(t):
    return joins.pairs_within_seconds(t.events, "user_id", 21_600, carry=["event_id"])


@query("j6_outer_alignment", with_views(EDGES) + """, o AS (SELECT src AS node, count(*) AS n_out FROM edges GROUP BY 1),
i AS (SELECT dst AS node, count(*) AS n_in FROM edges GROUP BY 1)
SELECT coalesce(o.node, i.node) AS node, coalesce(n_out, 0) AS n_out, coalesce(n_in, 0) AS n_in,
coalesce(n_out, 0) + coalesce(n_in, 0) AS n_all FROM o FULL JOIN i ON o.node = i.node""")
def _(t):
    out = t.edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("n_out"))
    into = t.edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n_in"))
    return out.join(into, "node", "full").na.fill(0, ["n_out", "n_in"]).withColumn("n_all", F.expr("n_out + n_in"))


@query("j7_semi_join", """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def _(t):
    keep = t.customer.filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").join(keep, "o_custkey", "left_semi").drop("o_custkey")


@query("j8_anti_join", "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left_anti")


_TEAMS = """teams AS (SELECT n_regionkey AS grp, n_name AS team, count(*) AS score FROM orders JOIN customer
  ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def team_scores(t):
    """Orders per nation, counted per customer first; one row per nation."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return (per_customer.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
            .groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("n").alias("score"))
            .join(t.nation, "n_nationkey")
            .select(F.col("n_regionkey").alias("grp"), F.col("n_name").alias("team"), "score"))


@query("j9_group_pairs", "WITH " + _TEAMS + """ SELECT a.grp, a.team AS team_a, b.team AS team_b, a.score AS score_a, b.score AS score_b
FROM teams a JOIN teams b ON a.grp = b.grp AND a.team < b.team""")
def _(t):
    return joins.group_pairs(team_scores(t), "grp", "team", ["score"])


@query("j10_trailing_day_mean", with_views(OHLCV) + """SELECT strftime(t.day, '%Y-%m-%d') AS day,
round((SELECT avg(h.volume) FROM ohlcv h WHERE h.day >= t.day - INTERVAL 7 DAY AND h.day < t.day), 4) AS trailing_mean FROM ohlcv t""")
def _(t):
    history = t.ohlcv.select("day", "volume")
    out = joins.trailing_day_mean(t.ohlcv.select("day"), history, "day", "volume")
    return out.select(F.col("day").cast("string").alias("day"), F.round("trailing_mean", 4).alias("trailing_mean"))


_IDS = with_views(RATINGS, EDGES) + """, u AS (SELECT user_id FROM ratings UNION SELECT src FROM edges UNION SELECT dst FROM edges),
ui AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM u),
ii AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM ratings)) """


@query("j11_dense_id_mapping", _IDS + """SELECT user_idx, item_idx, round(label, 6) AS label FROM ratings
JOIN ui USING (user_id) JOIN ii USING (item_id)""")
def _(t):
    ratings = materialise(t.ratings, "ratings")
    users = ratings.select("user_id").union(t.edges.select("src")).union(t.edges.select("dst")).distinct()
    items = ratings.select("item_id").distinct()
    by_user = skew.salted_join(ratings, with_position(users, ["user_id"], name="user_idx"), ["user_id"], spread_by=["item_id"])
    return (skew.salted_join(by_user, with_position(items, ["item_id"], name="item_idx"), ["item_id"],
                             hot=skew.hot_keys(ratings, ["item_id"]), spread_by=["user_id"])
            .select("user_idx", "item_idx", r6("label", "label")))


@query("j12_latest_difference", """WITH l AS (SELECT o_custkey, max_by(o_totalprice, struct_pack(d := o_orderdate, k := o_orderkey)) AS price
 FROM orders GROUP BY 1)
SELECT a.c_custkey AS home, b.o_custkey AS away, round(h.price - b.price, 2) AS diff FROM customer a
JOIN l h ON h.o_custkey = a.c_custkey JOIN l b ON b.o_custkey = a.c_custkey + 1""")
def _(t):
    latest = joins.latest_per_key(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_totalprice"])
    home = latest.select(F.col("o_custkey").alias("home"), F.col("o_totalprice").alias("hp"))
    away = latest.select(F.col("o_custkey").alias("away"), F.col("o_totalprice").alias("ap"))
    fixtures = t.customer.select(F.col("c_custkey").alias("home"), (F.col("c_custkey") + 1).alias("away"))
    return fixtures.join(home, "home").join(away, "away").select(
        "home", "away", F.round(F.col("hp") - F.col("ap"), 2).alias("diff"))


_OVERLAP = with_views(BOXES, PRED) + """, inter AS (
 SELECT b.filename, b.box_id, greatest(0, least(b.xmax, p.xmax) - greatest(b.xmin, p.xmin))
   * greatest(0, least(b.ymax, p.ymax) - greatest(b.ymin, p.ymin)) AS i,
   (b.xmax - b.xmin) * (b.ymax - b.ymin) AS sa, (p.xmax - p.xmin) * (p.ymax - p.ymin) AS sb
 FROM boxes b JOIN pred p ON b.filename = p.filename),
best AS (SELECT filename, box_id, max(i / (sa + sb - i + 1e-6::DOUBLE)) AS best_iou FROM inter GROUP BY 1, 2) """


@query("j13_best_overlap", _OVERLAP + "SELECT filename, box_id, round(best_iou, 6) AS best_iou FROM best")
def _(t):
    return joins.best_overlap(t.boxes, predicted_boxes(t.boxes)).withColumn("best_iou", F.round("best_iou", 6))


@query("e8_detection_quality", _OVERLAP + """SELECT round(avg(best_iou), 6) AS mean_iou,
round(count(*) FILTER (best_iou >= 0.5) / count(*)::DOUBLE, 6) AS detection_rate FROM best""")
def _(t):
    best = joins.best_overlap(t.boxes, predicted_boxes(t.boxes))
    return best.agg(r6(F.avg("best_iou"), "mean_iou"),
                    r6(F.count_if(F.col("best_iou") >= 0.5) / F.count("*"), "detection_rate"))


_GREEDY = with_views(BOXES, PRED).replace("WITH ", "WITH RECURSIVE ", 1) + """, inter AS (SELECT b.filename, b.box_id, p.pred_id, greatest(0, least(b.xmax, p.xmax) - greatest(b.xmin, p.xmin)) * greatest(0, least(b.ymax, p.ymax) - greatest(b.ymin, p.ymin)) AS i,
 (b.xmax - b.xmin) * (b.ymax - b.ymin) AS sa, (p.xmax - p.xmin) * (p.ymax - p.ymin) AS sb FROM boxes b JOIN pred p ON b.filename = p.filename),
pr AS MATERIALIZED (SELECT filename, pred_id, list(struct_pack(r := -iou, b := box_id) ORDER BY -iou, box_id) AS wants FROM (SELECT filename, box_id, pred_id, i / (sa + sb - i + 1e-6::DOUBLE) AS iou FROM inter) WHERE iou >= 0.5 GROUP BY 1, 2),
gs AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY pred_id) AS k FROM pr),
m AS (SELECT DISTINCT filename, 0::BIGINT AS k, []::VARCHAR[] AS taken, NULL::DOUBLE AS iou FROM gs UNION ALL
 SELECT filename, k, CASE WHEN free IS NULL THEN taken ELSE list_append(taken, free.b) END, -free.r FROM (
  SELECT g.filename, g.k, m.taken, list_filter(g.wants, lambda x: NOT list_contains(m.taken, x.b))[1] AS free FROM m JOIN gs g ON g.filename = m.filename AND g.k = m.k + 1))
SELECT filename, count(iou) AS n_correct, round(avg(iou), 6) AS mean_iou FROM m GROUP BY 1 HAVING count(iou) > 0"""


@query("j14_greedy_matching", _GREEDY)
def _(t):
    pairs = joins.overlapping_boxes(t.boxes, predicted_boxes(t.boxes))
    return joins.greedy_matches(pairs).groupBy("filename").agg(
        F.count("*").alias("n_correct"), r6(F.avg("iou"), "mean_iou"))


@query("j15_derived_columns", """SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS status_f,
CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS status_o, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS status_p FROM orders""")
def _(t):
    flags = [(F.col("o_orderstatus") == s).cast("int").alias(f"status_{s.lower()}") for s in ("F", "O", "P")]
    return t.orders.select("o_orderkey", "o_orderpriority", *flags)


@query("j16_dictionary_lookup", """SELECT event_id, event_type, r.rank AS type_rank FROM events
LEFT JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS rank FROM (SELECT DISTINCT event_type FROM events)) r USING (event_type)""")
def _(t):
    dictionary = with_position(t.events.select("event_type").distinct(), ["event_type"], name="type_rank")
    return t.events.select("event_id", "event_type").join(dictionary, "event_type", "left")


# --- set operations -----------------------------------------------------------------------------------

@query("u2_row_concat", """SELECT doc_id AS id, text, lang, CAST(NULL AS VARCHAR) AS url FROM documents
UNION ALL SELECT page_id, html, NULL, url FROM pages""")
def _(t):
    a = t.documents.select(F.col("doc_id").alias("id"), "text", "lang")
    b = t.pages.select(F.col("page_id").alias("id"), F.col("html").alias("text"), "url")
    return a.unionByName(b, allowMissingColumns=True)


@query("u3_priority_union", with_views(OHLCV) + """, fill AS (SELECT day + INTERVAL 1 DAY AS day, "close" FROM ohlcv),
u AS (SELECT day, "close", 0 AS p FROM ohlcv UNION ALL SELECT CAST(day AS DATE), "close", 1 FROM fill)
SELECT strftime(day, '%Y-%m-%d') AS day, arg_min("close", p) AS "close", min(p) AS source FROM u GROUP BY day""")
def _(t):
    original = t.ohlcv.select("day", "close", F.lit(0).alias("source"))
    filled = t.ohlcv.select(F.date_add("day", 1).alias("day"), "close", F.lit(1).alias("source"))
    both = original.unionByName(filled)
    return joins.first_per_key(both, ["day"], ["source"], ["close", "source"]).withColumn("day", F.col("day").cast("string"))


@query("u4_distinct_union", with_views(RATINGS, EDGES, GAPS) + """SELECT 'id' AS kind, CAST(user_id AS VARCHAR) AS v FROM
 (SELECT user_id FROM ratings UNION SELECT src FROM edges UNION SELECT dst FROM edges)
UNION ALL SELECT 'text', event_type FROM (SELECT DISTINCT event_type FROM gaps WHERE event_type IS NOT NULL)""")
def _(t):
    ids = t.ratings.select("user_id").union(t.edges.select("src")).union(t.edges.select("dst")).distinct()
    texts = t.events_with_gaps.select("event_type").na.drop().distinct()
    return ids.select(F.lit("id").alias("kind"), F.col("user_id").cast("string").alias("v")).union(
        texts.select(F.lit("text"), "event_type"))


@query("u5_set_difference", """SELECT text FROM (SELECT text FROM documents WHERE lang = 'en' EXCEPT ALL
SELECT text FROM documents WHERE source IN ('src1', 'src2'))""")
def _(t):
    pool = t.documents.filter("lang = 'en'").select("text")
    return pool.exceptAll(t.documents.filter("source IN ('src1', 'src2')").select("text"))
