"""Clustering and image-as-table queries (K*)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from brightledger.operators import clustering as cl
from brightledger.operators import density
from brightledger.operators import images as im
from brightledger.operators import models as m
from brightledger.operators.aggregates import frequency, histogram
from brightledger.plans.registry import query
from brightledger.plans.statistics import rounded
from brightledger.plans.view_sql import BOXES, with_views
from brightledger.session import materialise


def vectors(t):
    return materialise(m.with_features(t.embeddings, "embedding").select("vec_id", "features", "label"), "vectors")


@query("k1_inertia_by_k")
def _(t):
    return cl.inertia_by_k(vectors(t), range(1, 11))


@query("k2_silhouette_by_k")
def _(t):
    return cl.silhouette_by_k(vectors(t), range(2, 11))


@query("k2_plain_silhouette_by_k")
def _(t):
    return cl.plain_silhouette_by_k(vectors(t), range(2, 11), "vec_id")


@query("k2_label_silhouettes", """WITH v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
s AS MATERIALIZED (SELECT * FROM v ORDER BY substr(md5('42:' || vec_id), 1, 8), vec_id LIMIT 10000),
d AS (SELECT s.vec_id, s.label AS cluster, v.label, sum(CASE WHEN s.vec_id = v.vec_id THEN 0 ELSE list_distance(s.e, v.e) END) AS d, count(*) AS n FROM s, v GROUP BY 1, 2, 3),
m AS (SELECT vec_id, cluster, max(d / (n - 1)) FILTER (label = cluster AND n > 1) AS own, min(d / n) FILTER (label <> cluster) AS nearest FROM d GROUP BY 1, 2)
SELECT vec_id, cluster::BIGINT AS cluster, round(own, 5) AS own, round(nearest, 5) AS nearest FROM m""")
def _(t):
    """Mean distances inside the given cluster and to the nearest other one, whose difference makes the silhouette."""
    found = cl.silhouettes(t.embeddings, ["label"], "vec_id", "embedding")
    return rounded(found.select("vec_id", "cluster", "own", "nearest"), "own", "nearest", digits=5)


@query("k3_density_clusters")
def _(t):
    frame, _ = m.principal_components(vectors(t), 2)
    v = vector_to_array("components")
    points = frame.select(F.col("vec_id").alias("id"), v[0].alias("x"), v[1].alias("y"))
    return cl.density_clusters(points, 0.05, 5)


@query("k3_event_density_clusters")
def _(t):
    # events in the plane of (day of data, value): many points share a cell
    seconds = F.unix_timestamp("ts") - t.events.agg(F.unix_timestamp(F.min("ts"))).scalar()
    points = t.events.select(F.col("event_id").alias("id"), (seconds / 86400.0).alias("x"), (F.col("value") / 5.0).alias("y"))
    return cl.cluster_counts(cl.density_clusters(points, 0.3, 8))


# customers by balance, nation, number of orders and mean order price, scaled to comparable spreads
_SPACE = ["f0", "f1", "f2", "f3"]
_RADIUS, _LEAST = 0.35, 4


@query("k3_feature_clusters", f"""WITH RECURSIVE f AS MATERIALIZED (SELECT c_custkey AS id, round(c_acctbal / 3000::DOUBLE, 6) AS f0, c_nationkey / 8::DOUBLE AS f1,
    coalesce(n, 0) / 5::DOUBLE AS f2, round(coalesce(p, 0) / 50000, 6) AS f3
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, round(avg(o_totalprice), 2)::DOUBLE AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey),
e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM f a JOIN f b ON {" + ".join(f"(a.{x} - b.{x}) * (a.{x} - b.{x})" for x in _SPACE)} <= {_RADIUS}::DOUBLE * {_RADIUS}::DOUBLE),
core AS MATERIALIZED (SELECT a AS id FROM e GROUP BY a HAVING count(*) >= {_LEAST}),
ce AS MATERIALIZED (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
l AS (SELECT 0 AS k, id, id AS label FROM core UNION ALL SELECT k + 1, a, min(label) FROM l JOIN ce ON b = l.id WHERE k < 80 GROUP BY k, a),
r AS MATERIALIZED (SELECT id, dense_rank() OVER (ORDER BY label) - 1 AS label FROM l WHERE k = 80),
o AS (SELECT a AS id, min(label) AS label FROM e JOIN r ON r.id = b GROUP BY a)
SELECT f.id AS c_custkey, coalesce(r.label, o.label, -1)::INTEGER AS label FROM f LEFT JOIN r USING (id) LEFT JOIN o USING (id)""")
def _(t):
    """Density clusters of feature vectors, in more dimensions than the plane."""
    orders = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 2).alias("p"))
    rows = t.customer.join(orders, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", F.round(F.col("c_acctbal") / 3000.0, 6).alias("f0"), (F.col("c_nationkey") / 8.0).alias("f1"),
        (F.coalesce("n", F.lit(0)) / 5.0).alias("f2"), F.round(F.coalesce("p", F.lit(0.0)) / 50000.0, 6).alias("f3"))
    return density.density_clusters(rows, _SPACE, _RADIUS, _LEAST, key="c_custkey")


_LABELS = """l AS (SELECT vec_id, CASE WHEN label = 9 THEN -1 WHEN vec_id % 3 = 0 THEN 0 ELSE label END AS label FROM embeddings),
b AS (SELECT vec_id, CASE WHEN label = -1 THEN (SELECT max(label) FROM l) + 1 ELSE label END AS label FROM l)"""


def cluster_labels(t):
    return t.embeddings.select("vec_id", F.when(F.col("label") == 9, -1).when(F.col("vec_id") % 3 == 0, 0).otherwise(F.col("label")).alias("label"))


@query("k4_cluster_sizes", f"WITH {_LABELS} SELECT label, count(*) AS n FROM b GROUP BY 1")
def _(t):
    return cl.cluster_sizes(cluster_labels(t))


@query("k5_mid_sized_clusters", f"""WITH {_LABELS} SELECT vec_id, CASE WHEN n > 20 AND n < 60 THEN label ELSE 0 END AS label FROM b JOIN (SELECT label, count(*) AS n FROM b GROUP BY 1) USING (label)""")
def _(t):
    return cl.keep_mid_sized(cluster_labels(t), 20, 60)


# --- each vector drawn as an 8 x 8 colour image ---------------------------------------------------------

_PIXEL_SQL = """v AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(abs(e::DOUBLE) * 1000) AS BIGINT) % 256) AS p FROM embeddings),
px AS (SELECT 'vec_' || vec_id AS origin, i % 8 AS x, i // 8 AS y, p[i + 1] AS r, p[(i * 7 + 1) % 64 + 1] AS g, p[(i * 3 + 2) % 64 + 1] AS b FROM v, (SELECT unnest(generate_series(0, 63)) AS i)),
gr AS (SELECT *, 0.2989::DOUBLE * r + 0.5870::DOUBLE * g + 0.1140::DOUBLE * b AS grey FROM px)"""


def drawn(t):
    """An image struct per vector, as the image source gives it (blue, green, red bytes)."""
    p = F.transform("embedding", lambda e: F.pmod(F.floor(F.abs(e.cast("double")) * 1000), F.lit(256)))
    order = [k for i in range(64) for k in ((i * 3 + 2) % 64, (i * 7 + 1) % 64, i)]
    texts = F.transform(F.array(*[F.lit(k) for k in order]), lambda k: F.lpad(F.hex(F.get("p", k)), 2, "0"))
    v = t.embeddings.select("vec_id", p.alias("p"))
    return v.select(F.struct(
        F.concat(F.lit("vec_"), "vec_id").alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"),
        F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), F.unhex(F.array_join(texts, "")).alias("data")).alias("image"))


@query("k6_pixel_table", f"WITH {_PIXEL_SQL} SELECT origin, x, y, r, g, b, round(x / 8.0::DOUBLE, 6) AS pos_x, round(y / 8.0::DOUBLE, 6) AS pos_y FROM px")
def _(t):
    return rounded(im.pixels(drawn(t)), "pos_x", "pos_y")


@query("k7_grey_pixels", f"WITH {_PIXEL_SQL} SELECT origin, x, y, round(grey, 6) AS grey, round(r / 255.0::DOUBLE, 6) AS r01 FROM gr")
def _(t):
    return rounded(im.with_grey(im.pixels(drawn(t))).select("origin", "x", "y", "grey", "r01"), "grey", "r01")


def _near(dx, dy):
    def mirrored(c, d):
        return c if d == 0 else f"CASE WHEN a.{c} + {d} < 0 THEN 1 WHEN a.{c} + {d} > 7 THEN 6 ELSE a.{c} + {d} END"
    x = mirrored("x", dx) if dx else "a.x"
    y = mirrored("y", dy) if dy else "a.y"
    return f"(SELECT grey FROM gr n WHERE n.origin = a.origin AND n.x = {x} AND n.y = {y})"


@query("k8_blur_scores", f"WITH {_PIXEL_SQL}, lap AS (SELECT origin, grey, " + " + ".join(_near(*d) for d in ((1, 0), (-1, 0), (0, 1), (0, -1))) + """ - 4 * grey AS l FROM gr a)
SELECT origin, round(var_pop(l), 4) AS blur_score, round(stddev_pop(grey), 4) AS noise, CASE WHEN var_pop(l) < 30000 THEN 1 ELSE 0 END AS is_blurry FROM lap GROUP BY 1""")
def _(t):
    s = im.blur_scores(drawn(t), 30_000.0)
    return rounded(s, "blur_score", "noise", digits=4).select("origin", "blur_score", "noise", "is_blurry")


_SCORES = with_views(BOXES) + ", s AS (SELECT filename, box_id, (xmax - xmin) * (ymax - ymin) / 10.0::DOUBLE AS blur_score FROM boxes) "


def box_scores(t):
    score = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) / 10.0
    return t.boxes.select("filename", "box_id", score.alias("blur_score")).withColumn(
        "is_blurry", (F.col("blur_score") < im.BLUR_THRESHOLD).cast("int"))


@query("k9_blur_summary", _SCORES + """SELECT count(*) AS n, round(count(*) FILTER (blur_score < 100) / count(*)::DOUBLE, 6) AS share_blurry, round(avg(blur_score), 6) AS mean,
round(stddev_samp(blur_score), 6) AS std, round(quantile_cont(blur_score, 0.5), 6) AS median FROM s""")
def _(t):
    return rounded(im.blur_summary(box_scores(t)), "share_blurry", "mean", "std", "median")


@query("k9_blur_histogram", _SCORES + """, b AS (SELECT min(blur_score) AS lo, max(blur_score) AS hi FROM s)
SELECT bin, count(*) AS n, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 20, 6) AS lower FROM (SELECT least(CAST(floor((blur_score - lo) / ((hi - lo) / 20)) AS INTEGER) + 1, 20) AS bin, lo, hi FROM s, b) GROUP BY bin""")
def _(t):
    return rounded(histogram(box_scores(t), "blur_score", 20), "lower")


@query("k9_blur_shares", _SCORES + "SELECT CASE WHEN blur_score < 100 THEN 1 ELSE 0 END AS is_blurry, count(*) AS n, round(count(*) / (SELECT count(*) FROM s)::DOUBLE, 6) AS share FROM s GROUP BY 1")
def _(t):
    return rounded(frequency(box_scores(t), ["is_blurry"], "share"), "share")


@query("k9_lowest_scores", _SCORES + "SELECT filename, box_id, round(blur_score, 6) AS blur_score FROM s ORDER BY s.blur_score, filename, box_id LIMIT 10")
def _(t):
    return rounded(box_scores(t).select("filename", "box_id", "blur_score").orderBy("blur_score", "filename", "box_id").limit(10), "blur_score")


@query("k10_mean_crop_size", with_views(BOXES) + "SELECT CAST(floor(avg(xmax - xmin)) AS INTEGER) AS crop_width, CAST(floor(avg(ymax - ymin)) AS INTEGER) AS crop_height FROM boxes")
def _(t):
    return im.mean_crop_size(t.boxes)
