"""Streams: several batches equal the batch twin, restart, late rows, malformed messages."""

import itertools
import json
import os
import tempfile

from pyspark.sql import functions as F

from brightledger.streaming import io, queries


def folder():
    return tempfile.mkdtemp(prefix="run-stream-", dir="/tmp")


def message(i, when, customer="c", **extra):
    m = {"transaction_id": str(i), "timestamp": when, "customer_id": customer, "merchant_id": f"m{i % 2}", "merchant_category": "x",
         "payment_method": "pos", "amount": 100, "lat": 35.0, "lng": 51.0, "device_info": {}, "status": "approved",
         "commission_type": "flat", "commission_amount": 2, "vat_amount": 9, "total_amount": 111, "customer_type": "CIP",
         "risk_level": 1, "failure_reason": None}
    return json.dumps(m | extra)


CLOCK = itertools.count(1_700_000_000)


def put(base, name, lines):
    """Files are read in order of their time, which is set here so that it is never equal."""
    os.makedirs(f"{base}/in", exist_ok=True)
    with open(f"{base}/in/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    now = next(CLOCK)
    os.utime(f"{base}/in/{name}", (now, now))


def stream(spark, base, per_batch=1):
    return io.parse_transactions(io.text_stream(spark, f"{base}/in", per_batch))


def at(minute, second=0):
    return f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:{second:02d}Z"


def test_velocity_needs_more_than_five(spark):
    base = folder()
    put(base, "a", [message(i, at(0, i), "five") for i in range(5)] + [message(i, at(0, i), "six") for i in range(3)])
    put(base, "b", [message(i, at(1, i), "six") for i in range(3, 6)])
    put(base, "c", [message(99, at(60))])
    out = io.run_to_table(queries.velocity_alerts(stream(spark, base)), base)
    assert [(r["customer_id"], r["description"]) for r in out.collect()] == [("six", "More than 5 transactions in 2 minutes")]


def test_distance_and_amount_alerts(spark):
    base = folder()
    far = {"lat": 36.0}
    put(base, "a", [message(1, at(0), "near"), message(2, at(5), "near", lat=35.4), message(3, at(0), "far"), message(4, at(5), "far", **far),
                    message(5, at(0), "late"), message(6, at(5, 1), "late", **far), message(7, at(0), "same"), message(8, at(0), "same", **far)])
    put(base, "b", [message(9, at(6), "rich", amount=1001), message(10, at(6), "rich", amount=1000)])
    averages = spark.createDataFrame([("rich", 100.0)], "customer_id string, average_amount double")
    out = io.run_to_table(queries.fraud_alerts(stream(spark, base), averages), base)
    got = sorted((r["fraud_type"], r["customer_id"]) for r in out.collect())
    assert got == [("AMOUNT_ANOMALY", "rich"), ("GEOGRAPHICAL_IMPOSSIBILITY", "far")]


def test_batches_equal_the_batch_twin(spark):
    base = folder()
    lines = [message(i, at(i % 50, i % 60), f"c{i % 3}", commission_amount=i % 7) for i in range(300)]
    lines.sort(key=lambda x: json.loads(x)["timestamp"])
    for n in range(3):
        put(base, f"part{n}", lines[n * 100:(n + 1) * 100])
    put(base, "z", [message(1000, at(300))])
    table = io.parse_transactions(spark.read.text(f"{base}/in"))
    for k, make in enumerate((queries.commission_by_type, queries.sliding_counts, queries.commission_ratio)):
        out = io.run_to_table(make(stream(spark, base)), f"{base}/{k}")
        twin = make(table).filter(F.col("window_end") <= F.lit("2024-01-01 04:58:00").cast("timestamp"))
        assert out.exceptAll(twin).isEmpty() and twin.exceptAll(out).isEmpty() and not out.isEmpty()


def test_restart_gives_no_duplicates(spark):
    base = folder()
    put(base, "a", [message(i, at(0, i)) for i in range(4)])
    plan = lambda: queries.commission_by_type(stream(spark, base))
    io.run_to_table(plan(), base)
    put(base, "b", [message(i, at(0, 30 + i)) for i in range(4)] + [message(50, at(1))])
    io.run_to_table(plan(), base)
    put(base, "c", [message(60, at(30))])
    out = io.run_to_table(plan(), base).collect()
    assert sorted((str(r["window_start"]), r["total_commission"]) for r in out) == [
        ("2024-01-01 00:00:00", 16), ("2024-01-01 00:01:00", 2)]


def test_row_behind_the_watermark_is_dropped(spark):
    base = folder()
    put(base, "a", [message(1, at(0))])
    put(base, "b", [message(2, at(30))])
    put(base, "c", [message(3, at(30, 10))])  # lateness is judged by the watermark of the batch before
    put(base, "d", [message(4, at(0, 30))])
    put(base, "e", [message(5, at(90))])
    out = io.run_to_table(queries.commission_by_type(stream(spark, base)), base).collect()
    assert {str(r["window_start"]): r["total_commission"] for r in out} == {"2024-01-01 00:00:00": 2, "2024-01-01 00:30:00": 4}


def test_top_merchant_tie_takes_lowest_id(spark):
    base = folder()
    put(base, "a", [message(1, at(0)), message(2, at(1))])
    put(base, "b", [message(3, at(60))])
    out = io.run_to_table(queries.top_merchants(stream(spark, base)), base).collect()
    assert [(r["merchant_id"], r["total_commission"]) for r in out] == [("m0", 2)]
    twin = queries.top_merchants(io.parse_transactions(spark.read.text(f"{base}/in"))).collect()
    assert sorted(r["merchant_id"] for r in twin) == ["m0", "m1", "m1"]


def test_validation_stream_splits_and_goes_on(spark):
    base = folder()
    good = json.loads(message(1, at(0)))
    good["location"] = {"lat": good.pop("lat"), "lng": good.pop("lng")}
    bad_sum = good | {"transaction_id": "2", "total_amount": 5, "payment_method": "mobile"}
    put(base, "a", [json.dumps(good), "{broken", json.dumps(bad_sum)])
    put(base, "b", [json.dumps(good | {"transaction_id": "3"}), json.dumps({"a": 1})])
    as_of = F.lit("2024-01-01 01:00:00").cast("timestamp")
    io.run_all([io.validation_stream(io.text_stream(spark, f"{base}/in", 1), f"{base}/ok", f"{base}/err", f"{base}/rej", f"{base}/cp", as_of)])
    ok = spark.read.schema("transaction_id string, amount bigint").json(f"{base}/ok").collect()
    err = spark.read.schema("key string, value string").json(f"{base}/err").collect()
    rej = spark.read.schema("value string, reject_reason string").json(f"{base}/rej").collect()
    assert sorted(r["transaction_id"] for r in ok) == ["1", "3"]
    assert sorted(json.loads(r["value"])["error_code"] for r in err) == ["ERR_AMOUNT", "ERR_DEVICE"] and {r["key"] for r in err} == {"2"}
    assert sorted(r["reject_reason"] for r in rej) == ["malformed", "missing:transaction_id"]


def test_update_mode_and_broker_options(spark):
    base = folder()
    put(base, "a", [message(1, at(0))])
    q = io.sink(queries.commission_by_type(stream(spark, base)), "memory", f"{base}/cp", "update", name="updates")
    io.run_all([q])
    assert spark.table("updates").count() == 1
    assert io.broker_source_options("h:1", "t", group="g") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "kafka.group.id": "g"}
    assert io.broker_sink_options("h:1", "t", "/c")["topic"] == "t"
