"""Derived views that give the base tables the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.operators.skew import salted_join

TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _pick(key, names):
    """Choose ``names[key % len(names)]``."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (key % len(names)).cast("int") + 1)


def transactions(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id")
    amount = F.round(F.col("value") * 100).cast("bigint") * 100
    base = events.select(
        eid.alias("event_id"),
        eid.cast("string").alias("transaction_id"),
        "ts",
        F.concat(F.lit("cust_"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("merch_"), (eid % 50).cast("string")).alias("merchant_id"),
        F.col("event_type").alias("merchant_category"),
        _pick(eid, ["online", "pos", "mobile", "nfc"]).alias("payment_method"),
        amount.alias("amount"),
        F.when(eid % 20 == 0, "declined").otherwise("approved").alias("status"),
        _pick(eid, ["flat", "progressive", "tiered"]).alias("commission_type"),
        _pick(F.col("user_id"), ["individual", "CIP", "business"]).alias("customer_type"),
        F.when(eid % 50 == 0, 5).otherwise((1 + eid % 3).cast("int")).alias("risk_level"),
        (F.lit(35.7219) + ((k % 11) - 5) * F.lit(0.2)).alias("lat"),
        (F.lit(51.3347) + ((k % 7) - 3) * F.lit(0.2)).alias("lng"),
    )
    return base.withColumns({
        "commission_amount": F.expr("amount * 2 div 100"),
        "vat_amount": F.expr("amount * 9 div 100"),
        "total_amount": F.expr("amount + amount * 2 div 100 + amount * 9 div 100"),
    })


def transaction_messages(events: DataFrame) -> DataFrame:
    """Transactions as nested JSON text with faults placed by event id."""
    t = transactions(events)
    eid = F.col("event_id")
    phone = F.create_map(
        F.lit("os"), F.when(eid % 8 == 2, "iOS").otherwise("Android"),
        F.lit("app_version"), F.lit("2.4.1"), F.lit("device_model"), F.lit("model"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    device = F.when((F.col("payment_method") == "mobile") & (eid % 79 != 0), phone).otherwise(empty)
    location = F.struct(F.when(eid % 89 != 0, F.col("lat")).alias("lat"), F.col("lng").alias("lng"))
    body = F.to_json(F.struct(
        "transaction_id", F.date_format("ts", TIMESTAMP_TEXT).alias("timestamp"),
        "customer_id", "merchant_id", "merchant_category", "payment_method", "amount",
        location.alias("location"), device.alias("device_info"), "status", "commission_type",
        "commission_amount", "vat_amount",
        (F.col("total_amount") + F.when(eid % 97 == 0, 1).otherwise(0)).alias("total_amount"),
        "customer_type", "risk_level",
        F.when(F.col("status") == "declined", "CANCELLED").otherwise("none").alias("failure_reason"),
    ))
    return t.select("event_id", "ts", F.when(eid % 83 == 0, "{").otherwise(body).alias("value"))


def events_with_gaps(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_id") % 17 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"))


def boxes(lineitem: DataFrame) -> DataFrame:
    """One image per order; ``box_id`` packs the key of a line and its quantity into text that sorts as they do."""
    zero = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 50) == 0
    q = F.col("l_quantity").cast("int")
    xmin = (F.col("l_partkey") % 500).cast("int")
    ymin = (F.col("l_suppkey") % 400).cast("int")

    def unless_zero(c):
        return F.when(zero, 0).otherwise(c)

    return lineitem.select(
        F.format_string("img_%08d", "l_orderkey").alias("filename"),
        F.format_string("%03d_%08d_%08d_%02d", "l_linenumber", "l_partkey", "l_suppkey", q).alias("box_id"),
        F.lit(640).alias("width"), F.lit(480).alias("height"),
        unless_zero(xmin).alias("xmin"), unless_zero(ymin).alias("ymin"),
        unless_zero(xmin + 20 + 2 * q).alias("xmax"), unless_zero(ymin + 10 + q).alias("ymax"),
        F.col("l_linenumber").alias("shift"))


def predicted_boxes(b: DataFrame) -> DataFrame:
    return b.select(
        "filename", F.col("box_id").alias("pred_id"),
        (F.col("xmin") + F.col("shift")).alias("xmin"), (F.col("ymin") + 1).alias("ymin"),
        (F.col("xmax") + F.col("shift")).alias("xmax"), (F.col("ymax") + 1).alias("ymax"))


def ratings(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Mean score of a part by a customer. An order seldom has a part twice, so lines meet their order as they are and are summed once."""
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        (F.sum(1 + F.col("l_quantity").cast("int") % 5) / F.count("*")).alias("label"))


def edges(customer: DataFrame) -> DataFrame:
    n = customer.agg(F.count("*")).scalar()
    c = F.col("c_custkey")
    targets = F.array(
        (c * 7 + 3) % F.col("n"),
        F.when(c % 2 == 0, (c * 13 + 5) % F.col("n")))
    return (
        customer.filter(c % 10 != 9)
        .select("c_custkey", n.alias("n"))
        .select(c.alias("src"), F.explode(F.array_compact(targets)).alias("dst"), (1 + c % 3).alias("weight"))
        .filter("src <> dst")
        .groupBy("src", "dst").agg(F.max("weight").alias("weight")))


def daily_bars(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.sum("o_totalprice").alias("volume"))


def polls(orders: DataFrame) -> DataFrame:
    def percent(status):
        return 100.0 * F.count_if(F.col("o_orderstatus") == status) / F.count("*")

    return orders.groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("pollster")).agg(
        F.count("*").alias("n"), percent("F").alias("pct_f"), percent("O").alias("pct_o"))


def question_answers(conversations: DataFrame) -> DataFrame:
    """First user text of a conversation as the question, one row per assistant turn.

    The questions are one row per conversation, found with a map-side aggregate.
    """
    question = conversations.filter(F.col("role") == "user").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("question"))
    answers = conversations.filter(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("answer_turn"), F.col("text").alias("answer"))
    answered = salted_join(answers, question, ["conv_id"], spread_by=["answer_turn"])
    silent = question.join(answers, "conv_id", "left_anti").select(
        "*", F.lit(None).cast("bigint").alias("answer_turn"), F.lit(None).cast("string").alias("answer"))
    return answered.select(*silent.columns).unionByName(silent)


def class_probabilities(embeddings: DataFrame) -> DataFrame:
    """Softmax of the first three embedding values."""
    head = F.transform(F.slice("embedding", 1, 3), lambda v: F.exp(v.cast("double")))
    return embeddings.select("vec_id", "label", head.alias("e")).select(
        "vec_id", "label",
        F.transform("e", lambda v: v / (F.col("e")[0] + F.col("e")[1] + F.col("e")[2])).alias("probs"))
