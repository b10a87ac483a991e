"""Validation and streaming queries (P16-P19, S14, ST*): batch twins, and streams run to their end."""

from pyspark.sql import functions as F

from brightledger.operators import validation as v
from brightledger.plans.registry import query
from brightledger.plans.view_sql import TXN, with_views
from brightledger.session import scratch_path
from brightledger.sources.views import transactions
from brightledger.streaming import io, queries

NTZ = "timestamp_ntz"

_FAULTS = with_views(TXN) + """, m AS (SELECT *, (SELECT max(ts) FROM events) AS as_of, total_amount + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS total_sent FROM txn),
c AS (SELECT *, CASE WHEN event_id % 83 = 0 THEN 'malformed' WHEN event_id % 89 = 0 THEN 'missing:lat' END AS reject_reason,
 total_sent <> amount + vat_amount + commission_amount AS e1, ts > as_of OR ts < as_of - INTERVAL 1 DAY AS e2,
 payment_method = 'mobile' AND event_id % 79 = 0 AS e3 FROM m) """


def validated(t):
    as_of = t.events.agg(F.max("ts")).scalar()
    return v.validate(t.txn_json, as_of)


def timed(df):
    return df.withColumns({c: F.col(c).cast(NTZ) for c in ("window_start", "window_end") if c in df.columns})


@query("p16_flatten_and_cast", _FAULTS + """SELECT transaction_id, customer_id, amount, round(lat, 6) AS lat, round(lng, 6) AS lng, total_sent AS total_amount,
CAST(risk_level AS BIGINT) AS risk_level, ts AS event_time FROM c WHERE reject_reason IS NULL""")
def _(t):
    return validated(t).filter("reject_reason IS NULL").select(
        "transaction_id", "customer_id", "amount", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"),
        "total_amount", "risk_level", F.col("event_time").cast(NTZ).alias("event_time"))


@query("p17_required_keys", _FAULTS + "SELECT event_id, reject_reason FROM c WHERE reject_reason IS NOT NULL")
def _(t):
    return validated(t).filter("reject_reason IS NOT NULL").select("event_id", "reject_reason")


@query("p18_rule_codes", _FAULTS + """SELECT event_id, concat_ws(',', CASE WHEN e1 THEN 'ERR_AMOUNT' END, CASE WHEN e2 THEN 'ERR_TIME' END, CASE WHEN e3 THEN 'ERR_DEVICE' END) AS codes
FROM c WHERE reject_reason IS NULL""")
def _(t):
    return validated(t).filter("reject_reason IS NULL").select("event_id", F.array_join("errors", ",").alias("codes"))


@query("p19_error_rows", _FAULTS + """SELECT transaction_id, error_code, as_of AS "timestamp" FROM (
SELECT transaction_id, 'ERR_AMOUNT' AS error_code, as_of FROM c WHERE reject_reason IS NULL AND e1 UNION ALL
SELECT transaction_id, 'ERR_TIME', as_of FROM c WHERE reject_reason IS NULL AND e2 UNION ALL
SELECT transaction_id, 'ERR_DEVICE', as_of FROM c WHERE reject_reason IS NULL AND e3)""")
def _(t):
    rows = v.error_rows(validated(t)).select("transaction_id", "error_code", "timestamp")
    return rows.withColumn("timestamp", F.col("timestamp").cast(NTZ))


@query("p19_valid_rows", _FAULTS + """SELECT transaction_id, amount FROM c WHERE reject_reason IS NULL AND NOT e1 AND NOT e2 AND NOT e3""")
def _(t):
    return v.valid_rows(validated(t)).select("transaction_id", "amount")


@query("s14_keyed_messages", with_views(TXN) + """SELECT customer_id AS key, '{"customer_id":"' || customer_id || '","amount":' || amount || '}' AS value FROM txn""")
def _(t):
    return v.keyed_message(t.txn.select("customer_id", "amount"), "customer_id")


@query("st3_sliding_counts", with_views(TXN) + """, b AS (SELECT customer_id, ts, time_bucket(INTERVAL 20 MINUTE, ts) AS last_start FROM txn),
w AS (SELECT customer_id, last_start - k * INTERVAL 20 MINUTE AS window_start FROM b, (SELECT unnest([0, 1, 2]) AS k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, customer_id, count(*) AS n_txn FROM w GROUP BY 1, 2, 3""")
def _(t):
    return timed(queries.sliding_counts(t.txn, "1 hour", "20 minutes"))


_VELOCITY = """SELECT customer_id, 'VELOCITY_CHECK' AS fraud_type, 'More than 5 transactions in 1 day' AS description, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end FROM txn GROUP BY 1, 4 HAVING count(*) > 5"""
_DISTANCE = """SELECT a.customer_id, 'GEOGRAPHICAL_IMPOSSIBILITY' AS fraud_type, 'Transactions >50km apart within 360 minutes' AS description, a.ts AS window_start, b.ts AS window_end
FROM txn a JOIN txn b ON a.customer_id = b.customer_id AND epoch_ms(date_trunc('second', b.ts)) // 1000 - epoch_ms(date_trunc('second', a.ts)) // 1000 BETWEEN 1 AND 21600
WHERE 6371.0::DOUBLE * 2 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)))) > 50"""
_AMOUNT = """SELECT customer_id, 'AMOUNT_ANOMALY' AS fraud_type, 'Transaction amount >5x customer average' AS description, ts AS window_start, ts AS window_end
FROM txn JOIN (SELECT customer_id, avg(amount) AS m FROM txn GROUP BY 1) USING (customer_id) WHERE amount > m * 5"""


@query("st5_velocity_alerts", with_views(TXN) + _VELOCITY)
def _(t):
    return timed(queries.velocity_alerts(t.txn, "1 day", 5))


@query("st6_distance_alerts", with_views(TXN) + _DISTANCE)
def _(t):
    return timed(queries.distance_alerts(t.txn, 21_600, 50))


@query("st7_amount_alerts", with_views(TXN) + _AMOUNT)
def _(t):
    return timed(queries.amount_alerts(t.txn, queries.customer_averages(t.txn), 5))


_UNIFIED = f"SELECT * FROM ({_VELOCITY}) UNION ALL SELECT * FROM ({_DISTANCE}) UNION ALL SELECT * FROM ({_AMOUNT})"


@query("st8_unified_alerts", with_views(TXN) + _UNIFIED)
def _(t):
    return timed(queries.fraud_alerts(t.txn, queries.customer_averages(t.txn), "1 day", 5, 21_600, 50, 5))


@query("u1_alert_union_counts", with_views(TXN) + f"SELECT fraud_type, count(*) AS n FROM ({_UNIFIED}) GROUP BY 1")
def _(t):
    alerts = queries.fraud_alerts(t.txn, queries.customer_averages(t.txn), "1 day", 5, 21_600, 50, 5)
    return alerts.groupBy("fraud_type").agg(F.count("*").alias("n"))


@query("st9_commission_by_type", with_views(TXN) + """SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, commission_type,
CAST(sum(commission_amount) AS BIGINT) AS total_commission FROM txn GROUP BY 1, 2, 3""")
def _(t):
    return timed(queries.commission_by_type(t.txn))


@query("st10_commission_ratio", with_views(TXN) + """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
merchant_category, round(sum(commission_amount) / sum(amount)::DOUBLE, 9) AS commission_ratio FROM txn GROUP BY 1, 2, 3""")
def _(t):
    return timed(queries.commission_ratio(t.txn)).withColumn("commission_ratio", F.round("commission_ratio", 9))


@query("st11_top_merchants", with_views(TXN) + """, s AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, merchant_id, sum(commission_amount) AS total FROM txn GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, merchant_id, CAST(total AS BIGINT) AS total_commission
FROM (SELECT *, rank() OVER (PARTITION BY window_start ORDER BY total DESC) AS r FROM s) WHERE r = 1""")
def _(t):
    return timed(queries.top_merchants(t.txn))


# --- the same queries as streams over the events file, run to the end: update mode with keyed upserts, so open windows count ---

def stream_of(t):
    return transactions(io.event_stream(t.spark, t.folder))


def latest(t, df, keys, label):
    return timed(io.run_upserts(df, scratch_path(t.spark, label), keys))


@query("st2_stream_velocity", with_views(TXN) + _VELOCITY)
def _(t):
    return latest(t, queries.velocity_alerts(stream_of(t), "1 day", 5), ["customer_id", "window_start"], "velocity")


@query("st3_stream_sliding_counts", with_views(TXN) + """, b AS (SELECT customer_id, ts, time_bucket(INTERVAL 20 MINUTE, ts) AS last_start FROM txn),
w AS (SELECT customer_id, last_start - k * INTERVAL 20 MINUTE AS window_start FROM b, (SELECT unnest([0, 1, 2]) AS k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, customer_id, count(*) AS n_txn FROM w GROUP BY 1, 2, 3""")
def _(t):
    return latest(t, queries.sliding_counts(stream_of(t), "1 hour", "20 minutes"), ["customer_id", "window_start"], "sliding")


@query("st9_stream_commission", with_views(TXN) + """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
commission_type, CAST(sum(commission_amount) AS BIGINT) AS total_commission FROM txn GROUP BY 1, 2, 3""")
def _(t):
    return latest(t, queries.commission_by_type(stream_of(t), "1 hour"), ["window_start", "commission_type"], "commission")


@query("st11_stream_top_merchants", with_views(TXN) + """, s AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, merchant_id, sum(commission_amount) AS total FROM txn GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, merchant_id, CAST(total AS BIGINT) AS total_commission
FROM (SELECT *, rank() OVER (PARTITION BY window_start ORDER BY total DESC) AS r FROM s) WHERE r = 1""")
def _(t):
    sums = latest(t, queries.commission_by_merchant(stream_of(t), "1 hour"), ["window_start", "merchant_id"], "merchants")
    return queries.best_merchants(sums)


@query("st8_stream_alerts", with_views(TXN) + _UNIFIED)
def _(t):
    # velocity updates its windows; pairs and amounts are final when they come
    folder = scratch_path(t.spark, "alerts")
    velocity = queries.velocity_alerts(stream_of(t), "1 day", 5)
    final = {"distance": queries.distance_alerts(stream_of(t), 21_600, 50),
             "amount": queries.amount_alerts(stream_of(t), queries.customer_averages(t.txn), 5)}
    io.run_all([io.upserts(velocity, f"{folder}/velocity")] + [
        io.sink(df, "parquet", f"{folder}/{n}/checkpoint", path=f"{folder}/{n}/output") for n, df in final.items()])
    out = io.upserted(t.spark, velocity.schema, f"{folder}/velocity", ["customer_id", "window_start"])
    for n, df in final.items():
        out = out.unionByName(t.spark.read.schema(df.schema).parquet(f"{folder}/{n}/output"))
    return timed(out)
