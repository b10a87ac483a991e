"""Splits and selections (L1-L5, L20-L23) and evaluation metrics (E*)."""

from pyspark.sql import functions as F

from brightledger.operators import evaluation as ev
from brightledger.operators import selection as sel
from brightledger.plans.registry import query
from brightledger.plans.statistics import rounded
from brightledger.plans.view_sql import OHLCV, PROBS, lcs_sql, with_views

_HASH = "CAST('0x' || substr(md5('42:' || {k}), 1, 8) AS BIGINT)"


@query("l1_random_split", f"""SELECT o_orderkey, CASE WHEN {_HASH.format(k='o_orderkey')} / 4294967296.0::DOUBLE < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders""")
def _(t):
    return sel.random_split(t.orders.select("o_orderkey"), "o_orderkey", {"train": 0.8, "test": 0.2})


@query("l2_stratified_split", f"""SELECT doc_id, quality, CASE WHEN i < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM (SELECT doc_id, quality,
row_number() OVER (PARTITION BY quality ORDER BY {_HASH.format(k='doc_id')}, doc_id) - 1 AS i, count(*) OVER (PARTITION BY quality) AS n FROM labels)""")
def _(t):
    return sel.stratified_split(t.labels.select("doc_id", "quality"), "quality", "doc_id")


@query("l3_group_split", f"""SELECT split, count(*) AS n, count(DISTINCT l_orderkey) AS n_groups FROM (SELECT l_orderkey, CASE WHEN h < 0.7 THEN 'train' WHEN h < 0.7::DOUBLE + 0.15::DOUBLE THEN 'validation' ELSE 'test' END AS split
FROM (SELECT l_orderkey, {_HASH.format(k='l_orderkey')} / 4294967296.0::DOUBLE AS h FROM lineitem)) GROUP BY 1""")
def _(t):
    s = sel.random_split(t.lineitem.select("l_orderkey"), "l_orderkey", {"train": 0.7, "validation": 0.15, "test": 0.15})
    per_group = s.groupBy("split", "l_orderkey").agg(F.count("*").alias("n"))
    return per_group.groupBy("split").agg(F.sum("n").alias("n"), F.count("*").alias("n_groups"))


@query("l5_label_codes", """SELECT o_orderkey, o_orderpriority, code FROM orders JOIN (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
FROM (SELECT DISTINCT o_orderpriority FROM orders)) USING (o_orderpriority)""")
def _(t):
    return sel.label_codes(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query("l20_pseudo_labels", with_views(PROBS) + """SELECT vec_id, CASE WHEN p1 >= p2 AND p1 >= p3 THEN 0 WHEN p2 >= p3 THEN 1 ELSE 2 END AS pseudo_label FROM (
SELECT *, row_number() OVER (ORDER BY greatest(p1, p2, p3) DESC, vec_id) AS r, count(*) OVER () AS n FROM probs) WHERE r <= greatest(1, floor(n * 0.1::DOUBLE))""")
def _(t):
    return sel.pseudo_labels(t.probs, "probs", "vec_id", 0.1).select("vec_id", "pseudo_label")


@query("l21_pseudo_targets", """SELECT event_id, value FROM (SELECT event_id, value, row_number() OVER (ORDER BY abs(value - m) DESC, event_id) AS r, n
FROM (SELECT event_id, value, (SELECT avg(value) FROM events) AS m, count(*) OVER () AS n FROM events)) WHERE r <= greatest(1, floor(n * 0.05::DOUBLE))""")
def _(t):
    return sel.pseudo_targets(t.events.select("event_id", "value"), "value", "event_id", 0.05)


_UNCERTAIN = """SELECT * FROM (SELECT '{s}' AS strategy, vec_id, round({e}, 9) AS uncertainty FROM (SELECT *, greatest(p1, p2, p3) AS a, p1 + p2 + p3 - greatest(p1, p2, p3) - least(p1, p2, p3) AS b FROM probs)
ORDER BY {e} DESC, vec_id LIMIT 20)"""


@query("l23_uncertainty_queries", with_views(PROBS) + " UNION ALL ".join(_UNCERTAIN.format(s=s, e=e) for s, e in (
    ("least_confidence", "-a"), ("margin", "-(a - b)"),
    ("entropy", "-(p1 * ln(p1 + 1e-10) + p2 * ln(p2 + 1e-10) + p3 * ln(p3 + 1e-10))"))))
def _(t):
    out = None
    for s in (sel.LEAST_CONFIDENCE, sel.MARGIN, sel.ENTROPY):
        part = sel.most_uncertain(t.probs, "probs", "vec_id", s, 20).select(
            F.lit(s).alias("strategy"), "vec_id", F.round("uncertainty", 9).alias("uncertainty"))
        out = part if out is None else out.unionByName(part)
    return out


_GUESS = "CASE WHEN n_chars > 600 THEN 1 ELSE 0 END"


def guesses(t):
    d = t.documents.select("doc_id", (F.col("n_chars") > 600).cast("int").alias("guess"))
    return t.labels.join(d, "doc_id")


_REPORT = f"""WITH g AS (SELECT quality, {_GUESS} AS guess FROM labels JOIN documents USING (doc_id)), r AS (SELECT label, support, tp, predicted, tp / nullif(predicted, 0)::DOUBLE AS p, tp / nullif(support, 0)::DOUBLE AS q FROM (
SELECT label, (SELECT count(*) FROM g WHERE quality = label) AS support, (SELECT count(*) FROM g WHERE guess = label) AS predicted, (SELECT count(*) FROM g WHERE guess = label AND quality = label) AS tp FROM (SELECT unnest([0, 1]) AS label))),
f AS (SELECT label, support, tp, predicted, coalesce(p, 0) AS "precision", coalesce(q, 0) AS recall, coalesce(2 * p * q / nullif(p + q, 0), 0) AS f1 FROM r) """


@query("e1_classification_summary", _REPORT + """SELECT round(sum(tp) / sum(support)::DOUBLE, 6) AS accuracy, round(avg("precision"), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
round(sum("precision" * support) / sum(support), 6) AS weighted_precision, round(sum(recall * support) / sum(support), 6) AS weighted_recall, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM f""")
def _(t):
    out = ev.classification_summary(guesses(t), "quality", "guess")
    return rounded(out, *out.columns)


@query("e2_confusion_matrix", f"SELECT quality AS truth, {_GUESS} AS guess, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2")
def _(t):
    return ev.confusion(guesses(t), "quality", "guess")


@query("e3_class_report", _REPORT + """SELECT CAST(label AS INTEGER) AS label, support, tp, predicted, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f""")
def _(t):
    return rounded(ev.class_report(guesses(t), "quality", "guess"), "precision", "recall", "f1")


_OVR = with_views(PROBS) + """, o AS (SELECT k AS class, CASE WHEN label % 3 = k THEN 1 ELSE 0 END AS y, CASE k WHEN 0 THEN p1 WHEN 1 THEN p2 ELSE p3 END AS score FROM probs, (SELECT unnest([0, 1, 2]) AS k)),
rk AS (SELECT class, y, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0::DOUBLE AS r FROM o),
auc AS (SELECT class, (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))::DOUBLE AS auc FROM rk GROUP BY class) """


def scored(t):
    return ev.one_vs_rest(t.probs.withColumn("y", F.col("label") % 3), "y", "probs", 3)


@query("e4_roc_area", _OVR + "SELECT class, round(auc, 6) AS auc FROM auc")
def _(t):
    return rounded(ev.roc_area(scored(t), "label", "score", ["class"]), "auc")


@query("e4_macro_roc_area", _OVR + "SELECT round(avg(auc), 6) AS macro_auc FROM auc")
def _(t):
    return rounded(ev.macro_roc_area(t.probs.withColumn("y", F.col("label") % 3), "y", "probs", 3), "macro_auc")


@query("e4_binary_roc_area", """WITH rk AS (SELECT quality AS y, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE AS r FROM labels JOIN documents USING (doc_id))
SELECT round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))::DOUBLE, 6) AS auc FROM rk""")
def _(t):
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return rounded(ev.roc_area(d, "quality", "n_chars"), "auc")


@query("e5_roc_curve", _OVR + """SELECT class, round(threshold, 9) AS threshold, round(fp / nn::DOUBLE, 6) AS fpr, round(tp / np::DOUBLE, 6) AS tpr FROM (SELECT DISTINCT class, score AS threshold,
count(*) FILTER (y = 0) OVER w AS fp, count(*) FILTER (y = 1) OVER w AS tp, count(*) FILTER (y = 0) OVER (PARTITION BY class) AS nn, count(*) FILTER (y = 1) OVER (PARTITION BY class) AS np
FROM o WINDOW w AS (PARTITION BY class ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
def _(t):
    return rounded(ev.roc_curve(scored(t), "label", "score", ["class"]), "fpr", "tpr").withColumn("threshold", F.round("threshold", 9))


@query("e6_regression_summary", """WITH p AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS g FROM lineitem)
SELECT round(avg(abs(y - g)), 4) AS mae, round(avg(pow(y - g, 2)), 2) AS mse, round(sqrt(avg(pow(y - g, 2))), 4) AS rmse, round(1 - sum(pow(y - g, 2)) / (var_pop(y) * count(y)), 6) AS r2,
round(100 * avg(abs(y - g) / greatest(abs(y), 1e-8)), 6) AS mape, round(sum(y - g), 2) AS cumulative_error FROM p""")
def _(t):
    out = ev.regression_summary(t.lineitem.withColumn("guess", F.col("l_quantity") * 2000), "l_extendedprice", "guess")
    return rounded(rounded(rounded(out, "r2", "mape"), "mae", "rmse", digits=4), "mse", "cumulative_error", digits=2)


@query("e7_forecast_error", with_views(OHLCV) + """SELECT round(100 * avg(abs("close" - "open") / greatest(abs("close"), 1e-8)), 6) AS mape, round(sum("close" - "open"), 2) AS cumulative_error FROM ohlcv""")
def _(t):
    out = ev.regression_summary(t.ohlcv, "close", "open").select("mape", "cumulative_error")
    return rounded(out, "mape").withColumn("cumulative_error", F.round("cumulative_error", 2))


_MASKS = """WITH m AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS i, count(*) FILTER (l_returnflag = 'A' OR l_linestatus = 'F') AS u,
count(*) FILTER (l_returnflag = 'A') AS g, count(*) FILTER (l_linestatus = 'F') AS t FROM lineitem GROUP BY 1),
s AS (SELECT l_suppkey, 2 * i / (g + t + 1e-8::DOUBLE) AS dice, i / (u + 1e-8::DOUBLE) AS iou FROM m) """


def masks(t):
    return ev.mask_overlap(t.lineitem, "l_suppkey", F.col("l_returnflag") == "A", F.col("l_linestatus") == "F")


@query("e9_mask_overlap", _MASKS + "SELECT l_suppkey, round(dice, 6) AS dice, round(iou, 6) AS iou FROM s")
def _(t):
    return rounded(masks(t), "dice", "iou")


@query("e9_mean_mask_overlap", _MASKS + "SELECT round(avg(dice), 6) AS dice, round(avg(iou), 6) AS iou FROM s")
def _(t):
    return rounded(masks(t).agg(F.avg("dice").alias("dice"), F.avg("iou").alias("iou")), "dice", "iou")


_NORM = "trim(translate({c}, 'oOlLI]QS|sZB' || ' ' || chr(10) || '-.', '001111051528'))"
_TEXTQ = f"""WITH p AS (SELECT p_name AS truth, {_NORM.format(c='p_name')} AS t, p_type AS a, p_brand AS b FROM part),
l AS (SELECT 'first' AS method, truth, t, a AS raw FROM p UNION ALL SELECT 'second', truth, t, b FROM p UNION ALL SELECT 'third', truth, t, CASE WHEN length(truth) % 2 = 0 THEN truth ELSE upper(truth) END FROM p),
n AS (SELECT *, {_NORM.format(c='raw')} AS g FROM l)
SELECT method, round(avg(CASE WHEN truth = raw THEN 1.0::DOUBLE ELSE 0 END), 6) AS exact, round(avg(CASE WHEN t = g THEN 1.0::DOUBLE ELSE 0 END), 6) AS normalised, round(avg(levenshtein(t, g)), 6) AS mean_distance,
round(avg(1 - levenshtein(t, g) / greatest(length(t), 1)::DOUBLE), 6) AS char_accuracy FROM n GROUP BY 1"""


def text_report(t):
    third = F.when(F.length("p_name") % 2 == 0, F.col("p_name")).otherwise(F.upper("p_name"))
    p = t.part.select("p_name", "p_type", "p_brand", third.alias("third"))
    return ev.text_quality(p, "p_name", {"first": "p_type", "second": "p_brand", "third": "third"})


@query("e10_text_quality", _TEXTQ)
def _(t):
    return rounded(text_report(t).drop("mean_ratio"), "exact", "normalised", "mean_distance", "char_accuracy")


@query("e10_text_similarity", _TEXTQ[:_TEXTQ.index("SELECT method, round")].replace("WITH ", "WITH RECURSIVE ", 1) + ", pairs AS (SELECT DISTINCT t AS a, g AS b FROM n), " + lcs_sql("pairs") + """
SELECT method, round(avg(CASE WHEN length(t) + length(g) = 0 THEN 1 ELSE 2.0::DOUBLE * lcs.n / (length(t) + length(g)) END), 6) AS mean_ratio FROM n JOIN lcs ON t = a AND g = b GROUP BY 1""")
def _(t):
    return rounded(text_report(t).select("method", "mean_ratio"), "mean_ratio")
