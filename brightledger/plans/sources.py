"""Source and sink queries (S*): data of the tables is written in a format and read back."""

from pyspark.sql import functions as F

from brightledger.operators.validation import keyed_message
from brightledger.plans.registry import query
from brightledger.plans.streams import stream_of
from brightledger.plans.view_sql import BOXES, QA, TXN, with_views
from brightledger.session import scratch_path
from brightledger.sources import files, partitions
from brightledger.streaming import io, queries


@query("s1_csv_scan", "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def _(t):
    path = scratch_path(t.spark, "csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    files.write_csv(rows, path)
    return files.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string")


@query("s2_json_lines_scan", with_views(TXN) + "SELECT transaction_id, amount, status FROM txn")
def _(t):
    path = scratch_path(t.spark, "json")
    t.txn.select("transaction_id", "amount", "status", "merchant_category").write.json(path)
    return files.read_json_lines(t.spark, path, "transaction_id string, amount bigint, status string")


@query("s3_nested_json", with_views(QA) + """SELECT CAST(conv_id AS VARCHAR) AS "QID", question AS question_body, CAST(answer_turn AS VARCHAR) AS answer_id, answer AS answer_body FROM qa""")
def _(t):
    path = scratch_path(t.spark, "questions")
    one = F.struct(F.col("answer_turn").cast("string").alias("CID"), F.col("answer").alias("CBody"))
    # one document per answer: a long thread is never gathered into one row
    docs = t.qa.select(F.col("conv_id").cast("string").alias("QID"), F.col("question").alias("QBody"),
                       F.when(F.col("answer_turn").isNotNull(), F.array(one)).alias("Comments"))
    docs.write.json(path)
    return files.read_questions(t.spark, path, one_document_per_file=False).select("QID", "question_body", "answer_id", "answer_body")


def annotation_documents(t):
    """One document per box, some without text or without any object."""
    box = F.struct(
        F.struct(*[F.col(c).cast("int").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("bndbox"),
        F.when(F.col("shift") != 3, F.concat(F.lit(" "), "box_id")).alias("ocr_text"),
        F.when(F.col("shift") != 5, F.col("shift").cast("int")).alias("worth_ocr"))
    return t.boxes.select(
        F.lit("plates").alias("folder"), F.concat_ws("/", "filename", "box_id").alias("filename"),
        F.struct("width", "height").alias("size"), F.when(F.col("shift") != 7, F.array(box)).alias("object"))


@query("s4_xml_annotations", with_views(BOXES) + """SELECT filename || '/' || box_id AS filename, width, xmin, ymin, xmax, ymax, CASE WHEN shift <> 3 THEN box_id END AS ocr_text,
CASE WHEN shift <> 5 THEN shift END AS worth_ocr FROM boxes WHERE shift <> 7""")
def _(t):
    path = scratch_path(t.spark, "xml")
    files.write_annotations(annotation_documents(t), path)
    return files.annotation_rows(files.read_annotation_documents(t.spark, path)).drop("folder", "height")


@query("s5_incomplete_annotations", with_views(BOXES) + """SELECT filename || '/' || box_id AS filename, CASE shift WHEN 7 THEN 'no object' WHEN 3 THEN 'no ocr_text' ELSE 'no worth_ocr' END AS reason
FROM boxes WHERE shift IN (3, 5, 7)""")
def _(t):
    path = scratch_path(t.spark, "xml")
    files.write_annotations(annotation_documents(t), path)
    return files.incomplete_annotations(files.read_annotation_documents(t.spark, path))


@query("s9_stored_overwrite", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    path = scratch_path(t.spark, "table")
    t.orders.select("o_orderkey", "o_custkey").write.mode("overwrite").parquet(path)
    t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("s9_partition_overwrite", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders")
def _(t):
    path = scratch_path(t.spark, "table")
    stored = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    stored.write.partitionBy("o_orderstatus").parquet(path)
    partitions.overwrite_partitions(stored.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)), path, "o_orderstatus")
    return t.spark.read.parquet(path)


@query("p25_update_in_place", """WITH c AS (SELECT l_orderkey, max(l_extendedprice) AS m FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-06-01' GROUP BY 1)
SELECT o_orderkey, coalesce(m, o_totalprice) AS o_totalprice, year(o_orderdate)::INTEGER AS o_year FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def _(t):
    path = scratch_path(t.spark, "table")
    t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year")).write.partitionBy("o_year").parquet(path)
    changes = t.lineitem.filter("l_shipdate >= timestamp'1997-06-01'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("o_totalprice"))
    partitions.update_in_place(t.spark, path, changes, ["o_orderkey"], ["o_totalprice"], "o_year")
    return t.spark.read.parquet(path)


@query("s16_expired_in_place", "SELECT event_id, user_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 86400 SECOND")
def _(t):
    path = scratch_path(t.spark, "table")
    t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("day")).hint("rebalance", "day").write.partitionBy("day").parquet(path)
    partitions.expire_in_place(t.spark, path, t.events.agg(F.max("ts")).scalar(), time="ts")
    return t.spark.read.parquet(path).select("event_id", "user_id")


@query("s11_stream_json_append", with_views(TXN) + "SELECT transaction_id, customer_id, amount FROM txn WHERE status = 'approved'")
def _(t):
    folder = scratch_path(t.spark, "append")
    rows = stream_of(t).filter("status = 'approved'").select("transaction_id", "customer_id", "amount")
    io.run_all([io.sink(rows, "json", f"{folder}/checkpoint", path=f"{folder}/output")])
    return files.read_json_lines(t.spark, f"{folder}/output", "transaction_id string, customer_id string, amount bigint")


@query("s13_stream_messages", with_views(TXN) + """SELECT '{"transaction_id":"' || transaction_id || '","amount":' || amount || '}' AS value FROM txn""")
def _(t):
    rows = io.as_messages(stream_of(t).select("transaction_id", "amount"))
    return io.run_to_table(rows, scratch_path(t.spark, "messages"))


@query("s14_stream_keyed_messages", with_views(TXN) + """SELECT customer_id AS key, '{"customer_id":"' || customer_id || '","amount":' || amount || '}' AS value FROM txn""")
def _(t):
    rows = keyed_message(stream_of(t).select("customer_id", "amount"), "customer_id")
    return io.run_to_table(rows, scratch_path(t.spark, "keyed"))


@query("st1_parse_message_stream", with_views(TXN) + "SELECT transaction_id, amount, ts, CAST(risk_level AS INTEGER) AS risk_level FROM txn")
def _(t):
    folder = scratch_path(t.spark, "wire")
    wire = t.txn.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).drop("ts", "event_id")
    io.as_messages(wire).write.text(f"{folder}/in")
    parsed = io.parse_transactions(io.text_stream(t.spark, f"{folder}/in"))
    return io.run_to_table(parsed.select("transaction_id", "amount", F.col("ts").cast("timestamp_ntz").alias("ts"), "risk_level"), folder)


@query("st15_validation_stream", with_views(TXN) + """, m AS (SELECT max(ts) AS as_of FROM events), c AS (SELECT txn.*, event_id % 83 = 0 OR event_id % 89 = 0 AS rejected, event_id % 97 = 0 AS e1,
ts < as_of - INTERVAL 1 DAY AS e2, payment_method = 'mobile' AND event_id % 79 = 0 AS e3 FROM txn, m)
SELECT 'valid' AS sink, count(*) AS n FROM c WHERE NOT rejected AND NOT e1 AND NOT e2 AND NOT e3 UNION ALL SELECT 'rejected', count(*) FROM c WHERE rejected
UNION ALL SELECT 'errors', CAST(sum(CAST(e1 AS BIGINT) + CAST(e2 AS BIGINT) + CAST(e3 AS BIGINT)) AS BIGINT) FROM c WHERE NOT rejected""")
def _(t):
    folder = scratch_path(t.spark, "validation")
    t.txn_json.select("value").write.text(f"{folder}/in")
    latest = t.events.agg(F.max("ts").cast("string")).first()[0]
    paths = {k: f"{folder}/{k}" for k in ("valid", "errors", "rejected")}
    io.run_all([io.validation_stream(io.text_stream(t.spark, f"{folder}/in"), paths["valid"], paths["errors"], paths["rejected"],
                                     f"{folder}/checkpoint", F.lit(latest).cast("timestamp"))])
    out = None
    for name, path in paths.items():
        n = t.spark.read.schema("value string").json(path).agg(F.lit(name).alias("sink"), F.count("*").alias("n"))
        out = n if out is None else out.unionByName(n)
    return out


@query("st12_complete_mode", with_views(TXN) + """SELECT merchant_category, round(sum(commission_amount) / sum(amount)::DOUBLE, 9) AS commission_ratio FROM txn GROUP BY 1""")
def _(t):
    folder = scratch_path(t.spark, "complete")
    ratio = stream_of(t).groupBy("merchant_category").agg(
        F.round(F.try_divide(F.sum("commission_amount"), F.sum("amount")), 9).alias("commission_ratio"))

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/output")

    io.run_all([io.sink(ratio, "batch", f"{folder}/checkpoint", "complete", on_batch=store)])
    return t.spark.read.schema(ratio.schema).parquet(f"{folder}/output")


@query("st14_concurrent_queries", with_views(TXN) + """SELECT 'by_type' AS name, count(*) AS n FROM (SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, ts) AS w, commission_type FROM txn)
UNION ALL SELECT 'by_category', count(*) FROM (SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, ts) AS w, merchant_category FROM txn)""")
def _(t):
    folder = scratch_path(t.spark, "concurrent")
    plans = {"by_type": queries.commission_by_type(stream_of(t), "1 hour"), "by_category": queries.commission_ratio(stream_of(t), "1 hour")}
    keys = {"by_type": ["window_start", "commission_type"], "by_category": ["window_start", "merchant_category"]}
    io.run_all([io.upserts(df, f"{folder}/{n}") for n, df in plans.items()])
    out = None
    for n, df in plans.items():
        rows = io.upserted(t.spark, df.schema, f"{folder}/{n}", keys[n]).agg(F.lit(n).alias("name"), F.count("*").alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("s15_document_store", with_views(TXN) + """SELECT transaction_id AS id, ts AS "timestamp", customer_id, merchant_id, round(lat, 6) AS lat, round(lng, 6) AS long, merchant_category, amount, vat_amount, commission_type, commission_amount, total_amount,
customer_type, CAST(risk_level AS INTEGER) AS risk_level, CAST(NULL AS VARCHAR) AS failure_reason, payment_method, true AS has_time FROM txn WHERE status = 'approved'""")
def _(t):
    path = scratch_path(t.spark, "store")
    files.store_approved(t.txn, path)
    stored = t.spark.read.parquet(path)
    return stored.withColumns({"timestamp": F.col("timestamp").cast("timestamp_ntz"), "lat": F.round("lat", 6), "long": F.round("long", 6),
                               "has_time": F.col("createdAt").isNotNull()}).drop("day", "createdAt", "device_info")


@query("s16_expired_store", with_views(TXN) + """SELECT transaction_id AS id FROM txn WHERE status = 'approved' AND ts > (SELECT max(ts) FROM events) - INTERVAL 86400 SECOND""")
def _(t):
    path = scratch_path(t.spark, "store")
    files.store_approved(t.txn, path)
    files.expire(t.spark, path, f"{path}-kept", t.events.agg(F.max("ts")).scalar())
    return t.spark.read.parquet(f"{path}-kept").select("id")


@query("s17_vector_store", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[64] AS DOUBLE) AS last FROM embeddings")
def _(t):
    path = scratch_path(t.spark, "vectors")
    t.embeddings.select("vec_id", "embedding").write.parquet(path)
    v = t.spark.read.schema("vec_id bigint, embedding array<float>").parquet(path)
    return v.select("vec_id", F.size("embedding").alias("dims"), F.col("embedding")[0].cast("double").alias("first"), F.col("embedding")[63].cast("double").alias("last"))


@query("s19_reuse_or_build", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "reuse")
    files.reuse_or_build(t.spark, path, lambda: t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")))
    return files.reuse_or_build(t.spark, path, lambda: t.orders.groupBy("o_custkey").agg(F.lit(-1).cast("bigint").alias("n")))


@query("s6_coco", with_views(BOXES) + """SELECT filename AS file_name, CAST(xmin AS DOUBLE) AS x, CAST(ymin AS DOUBLE) AS y FROM boxes WHERE shift % 2 = 1
UNION ALL SELECT filename, NULL, NULL FROM boxes GROUP BY filename HAVING count(*) FILTER (shift % 2 = 1) = 0""")
def _(t):
    # one document per image, as a folder of annotation files
    path = scratch_path(t.spark, "coco")
    mark = F.struct(F.xxhash64("box_id").alias("id"), F.xxhash64("filename").alias("image_id"),
                    F.when(F.col("shift") % 2 == 1, 7).otherwise(8).alias("category_id"),
                    F.array(F.array(F.col("xmin").cast("double"), F.col("ymin").cast("double"))).alias("segmentation"))
    per = t.boxes.groupBy("filename").agg(F.collect_list(mark).alias("annotations"))
    per.select(F.array(F.struct(F.xxhash64("filename").alias("id"), F.col("filename").alias("file_name"))).alias("images"),
               F.array(F.struct(F.lit(7).alias("id"), F.lit("plate").alias("name"))).alias("categories"), "annotations").write.json(path)
    found = files.read_coco(t.spark, path, "plate", lines=True)
    return found.select("file_name", F.col("segmentation")[0][0].alias("x"), F.col("segmentation")[0][1].alias("y"))


@query("st13_restart", with_views(TXN) + """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, commission_type, CAST(sum(commission_amount) AS BIGINT) AS total_commission FROM txn GROUP BY 1, 2""")
def _(t):
    # the same query runs twice on one checkpoint, and half of the messages come between
    folder = scratch_path(t.spark, "restart")
    wire = t.txn.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    middle = t.events.agg(F.expr("timestamp_seconds((unix_timestamp(min(ts)) + unix_timestamp(max(ts))) / 2)")).scalar()
    out = None
    for late in (False, True):
        half = wire.filter((F.col("ts") >= middle) == F.lit(late)).drop("ts", "event_id")
        io.as_messages(half).write.mode("append").text(f"{folder}/in")
        plan = queries.commission_by_type(io.parse_transactions(io.text_stream(t.spark, f"{folder}/in")), "1 hour", "60 days")
        out = io.run_upserts(plan, folder, ["window_start", "commission_type"])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "commission_type", "total_commission")


@query("st16_malformed_messages", with_views(TXN) + "SELECT transaction_id, amount FROM txn WHERE event_id % 7 <> 0")
def _(t):
    folder = scratch_path(t.spark, "malformed")
    wire = t.txn.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    text = F.to_json(F.struct(*[c for c in wire.columns if c not in ("ts", "event_id")]))
    wire.select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{broken "), text)).otherwise(text).alias("value")).write.text(f"{folder}/in")
    parsed = io.parse_transactions(io.text_stream(t.spark, f"{folder}/in"))
    return io.run_to_table(parsed.select("transaction_id", "amount"), folder)
