"""Scans, filters, recoding, scalar functions and row repair (S7-S16, P*, F*, D*, M*, R*)."""

from pyspark.sql import functions as F

from brightledger.functions import dates, geometry, strings
from brightledger.operators import arrays, rows
from brightledger.operators.ordering import with_position
from brightledger.plans.registry import query
from brightledger.plans.view_sql import BOXES, GAPS, OHLCV, POLLS, PROBS, TXN, lcs_sql, with_views

NTZ = "timestamp_ntz"


def r6(c, alias):
    return F.round(c, 6).alias(alias)


# --- scans -----------------------------------------------------------------------------------

@query("s7_table_scan_limit", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def _(t):
    t.orders.createOrReplaceTempView("bl_orders")
    return t.spark.sql("SELECT o_orderkey, o_custkey, o_totalprice FROM bl_orders ORDER BY o_orderkey LIMIT 100")


_MODE_SQL = with_views(BOXES) + """, gapped AS (
  SELECT filename, box_id, CASE WHEN shift = 7 THEN NULL ELSE xmin END AS xmin, ymin, xmax, ymax FROM boxes)
SELECT 'train' AS mode, filename, box_id, xmin FROM gapped
WHERE xmin IS NOT NULL AND ymin IS NOT NULL AND xmax IS NOT NULL AND ymax IS NOT NULL
UNION ALL SELECT 'predict', filename, box_id, xmin FROM gapped
WHERE xmin IS NULL OR ymin IS NULL OR xmax IS NULL OR ymax IS NULL"""


@query("s8_mode_dependent_scan", _MODE_SQL)
def _(t):
    gapped = t.boxes.withColumn("xmin", F.when(F.col("shift") != 7, F.col("xmin")))

    def part(mode):
        return rows.scan_boxes(gapped, mode).select(F.lit(mode).alias("mode"), "filename", "box_id", "xmin")

    return part("train").unionByName(part("predict"))


@query("s16_retention", """SELECT event_id, user_id FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 86400 SECOND""")
def _(t):
    as_of = t.events.agg(F.max("ts")).scalar()
    return rows.retain_recent(t.events, "ts", as_of).select("event_id", "user_id")


# --- projection and filter ---------------------------------------------------------------------

@query("p1_select_rename", "SELECT o_orderkey AS order_id, o_totalprice AS amount FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_totalprice": "amount"})


@query("p2_drop_columns", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag,
l_linestatus FROM lineitem""")
def _(t):
    return rows.drop_columns(t.lineitem, ["l_extendedprice", "l_discount", "l_tax", "l_shipdate", "not_there"])


@query("p3_equality_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("p4_open_range_filter", "SELECT p_partkey, p_size FROM part WHERE 10 < p_size AND p_size < 30")
def _(t):
    return t.part.filter((F.col("p_size") > 10) & (F.col("p_size") < 30)).select("p_partkey", "p_size")


@query("p5_drop_null_rows", with_views(GAPS) + """
SELECT 'subset' AS rule, event_id FROM gaps WHERE value IS NOT NULL
UNION ALL SELECT 'any', event_id FROM gaps WHERE value IS NOT NULL AND event_type IS NOT NULL""")
def _(t):
    g = t.events_with_gaps
    return g.na.drop(subset=["value"]).select(F.lit("subset").alias("rule"), "event_id").unionByName(
        g.na.drop().select(F.lit("any").alias("rule"), "event_id"))


@query("p6_drop_empty_boxes", with_views(BOXES) + """
SELECT filename, box_id, xmin, ymin, xmax, ymax FROM boxes
WHERE NOT (xmin = 0 AND ymin = 0 AND xmax = 0 AND ymax = 0)""")
def _(t):
    return rows.drop_empty_boxes(t.boxes).select("filename", "box_id", "xmin", "ymin", "xmax", "ymax")


@query("p7_readable_text", """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '[NO TEXT]'
  WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS ocr_text FROM documents)
SELECT doc_id, ocr_text FROM d WHERE ocr_text IS NOT NULL AND ocr_text <> '[NO TEXT]'""")
def _(t):
    d = t.documents.select("doc_id", F.when(F.col("doc_id") % 7 == 0, rows.NO_TEXT)
                           .when(F.col("doc_id") % 5 != 0, F.col("source")).alias("ocr_text"))
    return d.filter(rows.readable_text(F.col("ocr_text")))


@query("p8_membership", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("p9_indicators", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_final,
CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_urgent FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", rows.indicator(F.col("o_orderstatus") == "F").alias("is_final"),
                           rows.indicator(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("is_urgent"))


@query("p10_part_of_day", """SELECT event_id, CASE WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'Morning'
WHEN hour(ts) >= 12 AND hour(ts) < 18 THEN 'Afternoon' WHEN hour(ts) >= 18 THEN 'Evening' ELSE 'Night' END
AS time_of_day FROM events""")
def _(t):
    return t.events.select("event_id", dates.part_of_day(F.hour("ts")).alias("time_of_day"))


@query("p11_timing_class", """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN -1
 ELSE date_diff('day', DATE '1998-06-01', CAST(o_orderdate AS DATE)) END AS days FROM orders)
SELECT o_orderkey, CASE WHEN days = -1 THEN 0 WHEN days < 0 THEN 1 WHEN days < 30 THEN 2 ELSE 3 END AS timing FROM d""")
def _(t):
    days = F.when(F.col("o_orderkey") % 11 == 0, -1).otherwise(
        F.datediff(F.to_date("o_orderdate"), F.lit("1998-06-01").cast("date")))
    return t.orders.select("o_orderkey", rows.timing_class(days).alias("timing"))


@query("p12_right_closed_bins", """SELECT p_partkey, CASE WHEN p_size <= 0 THEN NULL WHEN p_size <= 14.1 THEN 'Low'
WHEN p_size <= 20.8 THEN 'Medium' WHEN p_size <= 27.6 THEN 'High' WHEN p_size <= 45 THEN 'Very High' END AS band
FROM part""")
def _(t):
    return t.part.select("p_partkey", rows.right_closed_bins(
        F.col("p_size"), [0, 14.1, 20.8, 27.6, 45], ["Low", "Medium", "High", "Very High"]).alias("band"))


@query("p13_constant_fill", with_views(GAPS) + """SELECT event_id, coalesce(event_type, 'Unknown') AS event_type,
coalesce(value, -1) AS value FROM gaps""")
def _(t):
    return t.events_with_gaps.na.fill({"event_type": "Unknown", "value": -1.0}).select(
        "event_id", "event_type", "value")


@query("p14_recode", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4
WHEN '3-MEDIUM' THEN 3 ELSE 0 END AS ranked, CASE lower(o_orderstatus) WHEN 'f' THEN 1 WHEN 'o' THEN 0 END AS flag
FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey",
        rows.recode(F.col("o_orderpriority"), {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3}, 0).alias("ranked"),
        rows.recode(F.lower("o_orderstatus"), {"f": 1, "o": 0}).alias("flag"))


@query("p15_safe_number", """SELECT c_custkey, TRY_CAST(regexp_replace(c_name, '[^0-9.]', '', 'g') AS DOUBLE) AS digits,
TRY_CAST(regexp_replace(c_mktsegment, '[^0-9.]', '', 'g') AS DOUBLE) AS none FROM customer""")
def _(t):
    return t.customer.select("c_custkey", strings.digits_to_number(F.col("c_name")).alias("digits"),
                             strings.digits_to_number(F.col("c_mktsegment")).alias("none"))


@query("p20_money_shares", """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CAST(floor(l_extendedprice) AS BIGINT) AS amount FROM lineitem)
SELECT *, amount * 2 // 100 AS commission_amount, amount * 9 // 100 AS vat_amount,
amount + amount * 2 // 100 + amount * 9 // 100 AS total_amount FROM a""")
def _(t):
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                          F.floor("l_extendedprice").alias("amount"))
    return a.withColumns(rows.money_shares(F.col("amount")))


@query("p21_box_features", with_views(BOXES) + """SELECT filename, box_id, xmax - xmin AS bbox_width,
ymax - ymin AS bbox_height, (xmax - xmin) * (ymax - ymin) AS bbox_area,
round((xmax - xmin) / nullif(ymax - ymin, 0)::DOUBLE, 9) AS aspect_ratio,
round((xmax - xmin) * (ymax - ymin) / (width * height)::DOUBLE, 9) AS area_fraction,
round((xmin + xmax) / 2.0::DOUBLE / width, 9) AS center_x_norm, round((ymin + ymax) / 2.0::DOUBLE / height, 9) AS center_y_norm,
xmin AS margin_left, ymin AS margin_top, width - xmax AS margin_right, height - ymax AS margin_bottom FROM boxes""")
def _(t):
    ratios = ["aspect_ratio", "area_fraction", "center_x_norm", "center_y_norm"]
    return rows.box_features(t.boxes).withColumns({c: F.round(c, 9) for c in ratios}).drop(
        "width", "height", "xmin", "ymin", "xmax", "ymax", "shift")


@query("p22_rescaled_boxes", with_views(BOXES) + """SELECT filename, box_id,
round(xmin / (width / 224.0::DOUBLE), 6) AS xmin, round(ymin / (height / 224.0::DOUBLE), 6) AS ymin,
round(xmax / (width / 224.0::DOUBLE), 6) AS xmax, round(ymax / (height / 224.0::DOUBLE), 6) AS ymax FROM boxes""")
def _(t):
    return rows.rescale_boxes(t.boxes).select("filename", "box_id", *[F.round(c, 6).alias(c) for c in rows.BOX_COLUMNS])


@query("p23_clip", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
greatest(least(l_quantity, 40), 10) AS quantity FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             rows.clip(F.col("l_quantity"), 10.0, 40.0).alias("quantity"))


@query("p24_interactions", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
round(l_extendedprice * l_discount, 9) AS price_discount, round(l_extendedprice / nullif(l_quantity, 0), 9) AS unit_price,
round(l_quantity / pow((150 + l_linenumber) / 100.0::DOUBLE, 2), 9) AS mass_index FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice") * F.col("l_discount"), 9).alias("price_discount"),
        F.round(F.try_divide("l_extendedprice", "l_quantity"), 9).alias("unit_price"),
        F.round(rows.body_mass_index(F.col("l_quantity"), 150 + F.col("l_linenumber")), 9).alias("mass_index"))


@query("p25_keyed_update", with_views(BOXES) + """, scores AS (
  SELECT filename, max(xmax - xmin) AS shift FROM boxes GROUP BY filename HAVING max(xmax - xmin) > 60)
SELECT b.filename, b.box_id, coalesce(s.shift, b.shift) AS shift FROM boxes b LEFT JOIN scores s USING (filename)""")
def _(t):
    changes = t.boxes.groupBy("filename").agg(F.max(F.col("xmax") - F.col("xmin")).alias("shift")).filter("shift > 60")
    return rows.keyed_update(t.boxes, changes, ["filename"], ["shift"]).select("filename", "box_id", "shift")


@query("p26_add_missing_column", "SELECT o_orderkey, CAST(NULL AS DOUBLE) AS blur_score FROM orders")
def _(t):
    return rows.add_missing_columns(t.orders.select("o_orderkey"), {"o_orderkey": "bigint", "blur_score": "double"})


@query("p27_seeded_sample", """SELECT doc_id, lang FROM documents
ORDER BY substr(md5('42:' || doc_id), 1, 8), doc_id LIMIT 50""")
def _(t):
    return rows.seeded_sample(t.documents.select("doc_id", "lang"), "doc_id", 50)


@query("p28_preview", "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def _(t):
    return t.documents.select("doc_id", "source", "n_chars").orderBy("doc_id").limit(5)


# --- strings -------------------------------------------------------------------------------------

_OCR = """WITH p AS (SELECT p_partkey, p_name, p_brand, p_type,
  trim(translate(p_name, 'oOlLI]', '001111')) AS name_a,
  trim(translate(p_name, 'oOlLI]QS|sZB' || ' ' || chr(10) || '-.', '001111051528')) AS name_b,
  trim(translate(p_type, 'oOlLI]QS|sZB' || ' ' || chr(10) || '-.', '001111051528')) AS type_b FROM part) """


@query("f1_trim_and_join", """SELECT p_partkey, trim('  ' || p_name || ' ') AS name, CAST(p_size AS VARCHAR) AS size_text,
concat_ws('/', 'images', p_type, p_name) AS path FROM part""")
def _(t):
    return t.part.select("p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"),
                         F.col("p_size").cast("string").alias("size_text"),
                         strings.join_path("images", F.col("p_type"), F.col("p_name")).alias("path"))


@query("f2_lower_recode", """SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'household' THEN 1 WHEN 'machinery' THEN 0 END
AS flag FROM customer""")
def _(t):
    return t.customer.select("c_custkey", rows.recode(F.lower("c_mktsegment"),
                                                      {"household": 1, "machinery": 0}).alias("flag"))


@query("f3_plate_normalisation", _OCR + "SELECT p_partkey, name_a, name_b FROM p")
def _(t):
    return t.part.select("p_partkey", strings.normalise_plate(F.col("p_name")).alias("name_a"),
                         strings.normalise_plate_wide(F.col("p_name")).alias("name_b"))


@query("f5_edit_distance", _OCR + """SELECT p_partkey, levenshtein(name_b, type_b) AS distance,
round(1 - levenshtein(name_b, type_b) / greatest(length(name_b), 1)::DOUBLE, 6) AS char_accuracy FROM p""")
def _(t):
    a, b = (strings.normalise_plate_wide(F.col(c)) for c in ("p_name", "p_type"))
    return t.part.select("p_partkey", F.levenshtein(a, b).alias("distance"),
                         r6(strings.character_accuracy(a, b), "char_accuracy"))


@query("f6_similarity_ratio", _OCR.replace("WITH ", "WITH RECURSIVE ", 1) + ", pairs AS (SELECT DISTINCT name_b AS a, type_b AS b FROM p), " + lcs_sql("pairs") + """
SELECT a, b, round(CASE WHEN length(a) + length(b) = 0 THEN 1 ELSE 2.0::DOUBLE * n / (length(a) + length(b)) END, 6) AS ratio FROM lcs""")
def _(t):
    a, b = (strings.normalise_plate_wide(F.col(c)) for c in ("p_name", "p_type"))
    pairs = t.part.select(a.alias("a"), b.alias("b")).distinct()
    return pairs.select("a", "b", r6(strings.indel_ratio("a", "b"), "ratio"))


@query("f8_regex", """SELECT doc_id, regexp_replace(source, '[0-9]+', '#', 'g') AS masked,
regexp_extract(source, '([a-z]+)([0-9]+)', 2) AS number FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.regexp_replace("source", "[0-9]+", "#").alias("masked"),
                              F.regexp_extract("source", "([a-z]+)([0-9]+)", 2).alias("number"))


@query("f9_split_list", """SELECT doc_id, len(string_split(text, ',')) AS n_items,
trim(string_split(text, ',')[1], ' ') AS first_item, trim(string_split(text, ',')[-1], ' ') AS last_item FROM documents""")
def _(t):
    items = strings.split_list(F.col("text"), "None")
    # a text without a list is one item as it is, and a missing text has none, not even a number of them
    items = F.when(F.size(items) > 0, items).when(F.col("text").isNotNull(), F.array(F.trim("text")))
    return t.documents.select("doc_id", items.alias("i")).select(
        "doc_id", F.when(F.col("i").isNotNull(), F.size("i")).alias("n_items"), F.get("i", 0).alias("first_item"),
        F.try_element_at("i", F.lit(-1)).alias("last_item"))


@query("f10_lengths", r"""WITH d AS (SELECT doc_id, text,
  trim(regexp_replace(replace(text, '.', ''), '\s+', ' ', 'g')) AS bare FROM documents)
SELECT doc_id, length(text) AS n_characters, CASE WHEN bare = '' THEN 0 ELSE len(string_split(bare, ' ')) END AS n_words FROM d""")
def _(t):
    return t.documents.select("doc_id", F.length("text").alias("n_characters"),
                              strings.word_count(F.col("text")).alias("n_words"))


@query("f11_join_array", r"""SELECT doc_id, replace(regexp_replace(trim(text, ' '), '[ ]+', ' ', 'g'), ' ', '_') AS joined FROM documents""")
def _(t):
    words = F.split(F.trim("text"), "[ ]+")
    return t.documents.select("doc_id", F.array_join(words, "_").alias("joined"))


@query("f13_first_wrong", """SELECT p_partkey, CASE WHEN p_type <> p_brand THEN p_type WHEN p_name <> p_brand THEN p_name END AS wrong_a,
CASE WHEN p_name <> p_name THEN p_name WHEN p_type <> p_name THEN p_type END AS wrong_b FROM part""")
def _(t):
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return t.part.select("p_partkey", strings.first_wrong(brand, kind, name).alias("wrong_a"),
                         strings.first_wrong(name, name, kind).alias("wrong_b"))


# --- dates ---------------------------------------------------------------------------------------

@query("d1_parse_event_time", """SELECT event_id, CASE WHEN event_id % 83 <> 0 THEN ts END AS ts,
date_trunc('second', ts) AS ts_seconds FROM events""")
def _(t):
    m = t.txn_json.select("event_id", F.get_json_object("value", "$.timestamp").alias("text"), "ts")
    short = F.date_format("ts", dates.SECOND_PATTERN)
    return m.select("event_id", dates.parse_event_time(F.col("text")).cast(NTZ).alias("ts"),
                    dates.parse_event_time(short).cast(NTZ).alias("ts_seconds"))


@query("d2_parse_day_first", """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'bad'
 ELSE strftime(o_orderdate, '%d-%m-%Y') END AS txt FROM orders)
SELECT o_orderkey, strftime(try_strptime(txt, '%d-%m-%Y'), '%Y-%m-%d') AS day FROM d""")
def _(t):
    text = F.when(F.col("o_orderkey") % 9 == 0, "bad").otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    return t.orders.select("o_orderkey", dates.parse_day_first(text).cast("string").alias("day"))


@query("d3_time_parts", """SELECT event_id, hour(ts) AS hour, minute(ts) AS minute, isodow(ts) - 1 AS weekday,
year(ts) AS year, strftime(ts, '%H:00') AS hour_label FROM events""")
def _(t):
    return t.events.select("event_id", F.hour("ts").alias("hour"), F.minute("ts").alias("minute"),
                           F.weekday("ts").alias("weekday"), F.year("ts").alias("year"),
                           dates.hour_label(F.col("ts")).alias("hour_label"))


@query("d5_age", """WITH d AS (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2010-01-01') AS days FROM orders)
SELECT o_orderkey, days, CAST(floor(days / 365.0) AS BIGINT) AS age FROM d""")
def _(t):
    day, end = F.to_date("o_orderdate"), F.lit("2010-01-01").cast("date")
    return t.orders.select("o_orderkey", F.datediff(end, day).alias("days"), dates.age_years(day, end).alias("age"))


@query("d6_epoch_gap", """SELECT event_id, epoch_ms(date_trunc('second', ts)) // 1000 AS seconds,
epoch_ms(date_trunc('second', ts)) // 1000 - epoch_ms(date_trunc('day', ts)) // 1000 AS into_day FROM events""")
def _(t):
    return t.events.select("event_id", F.unix_timestamp("ts").alias("seconds"),
                           dates.seconds_between(F.date_trunc("day", "ts"), F.col("ts")).alias("into_day"))


@query("d7_event_age_check", """SELECT event_id, CASE WHEN ts > m OR ts < m - INTERVAL 1 DAY THEN 1 ELSE 0 END AS late
FROM events, (SELECT max(ts) - INTERVAL 3 DAY AS m FROM events)""")
def _(t):
    as_of = t.events.agg(F.max("ts") - F.expr("INTERVAL 3 DAYS")).scalar()
    return t.events.select("event_id", dates.outside_day_before(F.col("ts"), as_of).cast("int").alias("late"))


# --- numbers ---------------------------------------------------------------------------------------

@query("m1_great_circle", with_views(TXN) + """, h AS (SELECT event_id,
 pow(sin(radians(lat - 35.7::DOUBLE) / 2), 2) + cos(radians(35.7::DOUBLE)) * cos(radians(lat)) * pow(sin(radians(lng - 51.4::DOUBLE) / 2), 2) AS a FROM txn)
SELECT event_id, round(6371.0::DOUBLE * 2 * atan2(sqrt(a), sqrt(1 - a)), 6) AS km FROM h""")
def _(t):
    return t.txn.select("event_id", r6(geometry.great_circle_km(
        F.lit(35.7), F.lit(51.4), F.col("lat"), F.col("lng")), "km"))


@query("ud1_sql_function", with_views(TXN) + """, h AS (SELECT event_id,
 pow(sin(radians(lat - 35.7::DOUBLE) / 2), 2) + cos(radians(35.7::DOUBLE)) * cos(radians(lat)) * pow(sin(radians(lng - 51.4::DOUBLE) / 2), 2) AS a FROM txn)
SELECT event_id, round(6371.0::DOUBLE * 2 * asin(sqrt(a)), 5) AS km FROM h""")
def _(t):
    geometry.register_sql_functions(t.spark)
    t.txn.createOrReplaceTempView("bl_txn")
    return t.spark.sql("SELECT event_id, round(great_circle_km(35.7D, 51.4D, lat, lng), 5) AS km FROM bl_txn")


@query("m2_numeric_functions", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(ln(l_extendedprice), 6) AS log_price,
round(sqrt(l_quantity), 6) AS root, abs(l_quantity - 25) AS gap, round(pow(l_discount, 2), 6) AS square FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(F.log("l_extendedprice"), "log_price"),
        r6(F.sqrt("l_quantity"), "root"), F.abs(F.col("l_quantity") - 25).alias("gap"),
        r6(F.pow("l_discount", F.lit(2)), "square"))


@query("m3_linear_trend", with_views(POLLS) + """, daily AS (
  SELECT day, sum(pct_f * n / 100) / sum(n) AS share FROM polls GROUP BY day),
i AS (SELECT day, share, row_number() OVER (ORDER BY day) - 1 AS idx FROM daily),
f AS (SELECT regr_slope(share, idx) AS slope, regr_intercept(share, idx) AS icpt FROM i)
SELECT strftime(day, '%Y-%m-%d') AS day, idx, round(share, 6) AS share, round(icpt + slope * idx, 6) AS trend FROM i, f""")
def _(t):
    daily = t.polls.groupBy("day").agg((F.sum(F.col("pct_f") * F.col("n") / 100) / F.sum("n")).alias("share"))
    placed = arrays.with_trend(with_position(daily, ["day"]), "idx", "share")
    return placed.select(F.col("day").cast("string").alias("day"), "idx", r6("share", "share"), r6("trend", "trend"))


@query("m4_min_max_rescale", with_views(OHLCV) + """, b AS (SELECT min("close") AS lo, max("close") AS hi FROM ohlcv)
SELECT strftime(day, '%Y-%m-%d') AS day, round(("close" - lo) / (hi - lo), 6) AS scaled,
round(("close" - lo) / (hi - lo) * (hi - lo) + lo, 4) AS restored FROM ohlcv, b""")
def _(t):
    s = arrays.min_max_scaled(t.ohlcv, "close", "scaled", "restored")
    return s.select(F.col("day").cast("string").alias("day"), r6("scaled", "scaled"), F.round("restored", 4).alias("restored"))


@query("m5_standard_score", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS z FROM lineitem""")
def _(t):
    return arrays.standardised(t.lineitem, "l_quantity", "z").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6("z", "z"))


@query("m6_vector_norms", """SELECT vec_id, round(list_dot_product(v, v), 6) AS dot_self, round(sqrt(list_dot_product(v, v)), 6) AS norm,
round(v[1] / sqrt(list_dot_product(v, v)), 6) AS unit_first FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""")
def _(t):
    v = F.col("embedding")
    return t.embeddings.select("vec_id", r6(geometry.dot(v, v), "dot_self"), r6(geometry.norm(v), "norm"),
                               r6(geometry.normalised(v)[0], "unit_first"))


# --- maps, arrays, JSON ------------------------------------------------------------------------------

@query("r1_map_access", with_views(TXN) + """SELECT event_id, CASE WHEN event_id % 83 <> 0 AND payment_method = 'mobile' AND event_id % 79 <> 0
 THEN CASE WHEN event_id % 8 = 2 THEN 'iOS' ELSE 'Android' END END AS os FROM txn""")
def _(t):
    device = F.from_json("value", "device_info map<string,string>")["device_info"]
    return t.txn_json.select("event_id", F.try_element_at(device, F.lit("os")).alias("os"))


@query("r2_from_json", "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k int").alias("d")).select("event_id", "d.*")


@query("r3_to_json", """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS value FROM events""")
def _(t):
    return t.events.select("event_id", F.to_json(F.struct("event_id", "event_type", "user_id")).alias("value"))


@query("r4_explode", """SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) - 1 AS line_no,
unnest(string_split(text, chr(10))) AS line FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query("r5_multi_hot", """SELECT doc_id, CAST(contains(text, ' de ') AS INTEGER) AS has_de, CAST(contains(text, ' la ') AS INTEGER) AS has_la,
CAST(contains(text, ' the ') AS INTEGER) AS has_the FROM documents""")
def _(t):
    listed = t.documents.select("doc_id", F.array_compact(F.array(
        *[F.when(F.col("text").contains(f" {w} "), F.lit(w)) for w in ("the", "la", "de", "und")])).alias("words"))
    return arrays.multi_hot(listed, "words", ["the", "la", "de"], "has_").drop("words")


@query("r5_multi_hot_rows", """SELECT doc_id, label FROM documents, (SELECT unnest(['the', 'la', 'de', 'und']) AS label) WHERE contains(text, ' ' || label || ' ')
AND label IN (SELECT label FROM documents, (SELECT unnest(['the', 'la', 'de', 'und']) AS label) WHERE contains(text, ' ' || label || ' ') AND lang = 'en')""")
def _(t):
    words = [F.when(F.col("text").contains(f" {w} "), F.lit(w)) for w in ("the", "la", "de", "und")]
    listed = t.documents.select("doc_id", "lang", F.array_compact(F.array(*words)).alias("words"))
    return arrays.multi_hot_rows(listed, "doc_id", "words", arrays.learn_labels(listed.filter("lang = 'en'"), "words"))


@query("r6_array_extremes", with_views(PROBS) + """SELECT vec_id, round(greatest(p1, p2, p3), 6) AS top,
CASE WHEN p1 >= p2 AND p1 >= p3 THEN 0 WHEN p2 >= p3 THEN 1 ELSE 2 END AS best,
round(p1 + p2 + p3 - greatest(p1, p2, p3) - least(p1, p2, p3), 6) AS second,
round(-(p1 * ln(p1 + 1e-10) + p2 * ln(p2 + 1e-10) + p3 * ln(p3 + 1e-10)), 6) AS entropy FROM probs""")
def _(t):
    p = F.col("probs")
    return t.probs.select("vec_id", r6(F.array_max(p), "top"), geometry.argmax(p).alias("best"),
                          r6(geometry.second_max(p), "second"), r6(geometry.entropy(p), "entropy"))
