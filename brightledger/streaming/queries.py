"""Streaming analytics. Every function takes a DataFrame with an event-time column ``ts`` and works
the same on a stream and on a table; on a stream the watermark bounds the state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightledger.functions.geometry import great_circle_km
from brightledger.operators.joins import above_average, distant_pairs

WATERMARK = "2 minutes"
ALERT_COLUMNS = ["customer_id", "fraud_type", "description", "window_start", "window_end"]


def watermarked(txns: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Rows later than ``delay`` behind the newest event may be dropped (streams only)."""
    return txns.withWatermark("ts", delay) if txns.isStreaming else txns


def _flat(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def sliding_counts(txns: DataFrame, width: str = "1 minute", slide: str = "20 seconds", delay: str = WATERMARK) -> DataFrame:
    return _flat(watermarked(txns, delay).groupBy(F.window("ts", width, slide).alias("window"), "customer_id").agg(
        F.count("*").alias("n_txn")))


def commission_by_type(txns: DataFrame, width: str = "1 minute", delay: str = WATERMARK) -> DataFrame:
    return _flat(watermarked(txns, delay).groupBy(F.window("ts", width).alias("window"), "commission_type").agg(
        F.sum("commission_amount").alias("total_commission")))


def commission_ratio(txns: DataFrame, width: str = "5 minutes", delay: str = WATERMARK) -> DataFrame:
    return _flat(watermarked(txns, delay).groupBy(F.window("ts", width).alias("window"), "merchant_category").agg(
        F.try_divide(F.sum("commission_amount"), F.sum("amount")).alias("commission_ratio")))


def commission_by_merchant(txns: DataFrame, width: str = "5 minutes", delay: str = WATERMARK) -> DataFrame:
    return _flat(watermarked(txns, delay).groupBy(F.window("ts", width).alias("window"), "merchant_id").agg(
        F.sum("commission_amount").alias("total_commission")))


def best_merchants(sums: DataFrame) -> DataFrame:
    """The merchants of the highest commission of every window of a table that an update-mode query keeps; all of ties."""
    best = sums.groupBy("window_start").agg(F.max("total_commission").alias("total_commission"))
    return sums.join(best, ["window_start", "total_commission"]).select("window_start", "window_end", "merchant_id", "total_commission")


def top_merchants(txns: DataFrame, width: str = "5 minutes", delay: str = WATERMARK) -> DataFrame:
    """Merchant with the highest commission per window. On a stream a second aggregation picks the
    best (lowest id of ties); on a table all ties are kept."""
    sums = watermarked(txns, delay).groupBy(F.window("ts", width).alias("window"), "merchant_id").agg(
        F.sum("commission_amount").alias("total_commission"))
    if not txns.isStreaming:
        w = Window.partitionBy("window").orderBy(F.desc("total_commission"))
        return _flat(sums.withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r"))
    best = F.min(F.struct((-F.col("total_commission")).alias("c"), F.col("merchant_id").alias("m")))
    picked = sums.groupBy("window").agg(best.alias("_b"))
    return _flat(picked.select("window", F.col("_b.m").alias("merchant_id"), (-F.col("_b.c")).alias("total_commission")))


def _minutes(seconds: int) -> str:
    return f"{seconds // 60} minutes" if seconds % 60 == 0 else f"{seconds} seconds"


#: The kinds and texts of alerts are fixed values: receivers read them.
def _alert(df: DataFrame, kind: str, text: str, start, end) -> DataFrame:
    return df.select("customer_id", F.lit(kind).alias("fraud_type"), F.lit(text).alias("description"),
                     start.alias("window_start"), end.alias("window_end"))


def velocity_alerts(txns: DataFrame, width: str = "2 minutes", more_than: int = 5, delay: str = WATERMARK) -> DataFrame:
    counts = watermarked(txns, delay).groupBy("customer_id", F.window("ts", width).alias("window")).agg(
        F.count("*").alias("_n"))
    return _alert(counts.filter(F.col("_n") > more_than), "VELOCITY_CHECK", f"More than {more_than} transactions in {width}",
                  F.col("window.start"), F.col("window.end"))


def distance_alerts(txns: DataFrame, seconds: int = 300, km: float = 50.0, delay: str = WATERMARK) -> DataFrame:
    """Pairs of one customer too far apart for their time gap. On a stream: two watermarks and an
    interval condition, so old rows leave the join state."""
    if not txns.isStreaming:
        out = distant_pairs(txns, "customer_id", seconds, km)
        start, end = F.col("ts_1"), F.col("ts_2")
    else:
        base = watermarked(txns, delay)
        # both sides meet on (customer, time slot), so one busy customer's state is spread over time
        slot = F.floor(F.unix_timestamp("ts") / seconds)
        a = base.select("customer_id", F.explode(F.array(slot, slot + 1)).alias("_slot_1"), *[F.col(c).alias(f"{c}_1") for c in ("ts", "lat", "lng")])
        b = base.select(F.col("customer_id").alias("_c"), slot.alias("_slot_2"), *[F.col(c).alias(f"{c}_2") for c in ("ts", "lat", "lng")])
        gap = F.unix_timestamp("ts_2") - F.unix_timestamp("ts_1")
        # one second wider than the whole-second rule below, only to bound the state
        bounds = F.expr(f"ts_2 >= ts_1 AND ts_2 <= ts_1 + INTERVAL {seconds + 1} SECONDS")
        pairs = a.join(b, (F.col("customer_id") == F.col("_c")) & (F.col("_slot_1") == F.col("_slot_2")) & bounds).filter((gap > 0) & (gap <= seconds))
        far = great_circle_km(*[F.col(c) for c in ("lat_1", "lng_1", "lat_2", "lng_2")]) > km
        out, start, end = pairs.filter(far), F.col("ts_1"), F.col("ts_2")
    return _alert(out, "GEOGRAPHICAL_IMPOSSIBILITY", f"Transactions >{km:g}km apart within {_minutes(seconds)}", start, end)


def amount_alerts(txns: DataFrame, averages: DataFrame, factor: float = 10) -> DataFrame:
    """Amount above ``factor`` times the customer's historic average (stream-static join)."""
    columns = txns.select("customer_id", "amount", "ts")
    if txns.isStreaming:  # a batch is small and the static side arrives by its own size
        odd = columns.join(averages, "customer_id").filter(F.col("amount") > F.col("average_amount") * factor)
    else:
        odd = above_average(columns, averages, "customer_id", factor)
    return _alert(odd, "AMOUNT_ANOMALY", f"Transaction amount >{factor:g}x customer average", F.col("ts"), F.col("ts"))


def customer_averages(history: DataFrame) -> DataFrame:
    return history.groupBy("customer_id").agg(F.avg("amount").alias("average_amount"))


def fraud_alerts(txns: DataFrame, averages: DataFrame, width: str = "2 minutes", more_than: int = 5, seconds: int = 300,
                 km: float = 50.0, factor: float = 10, delay: str = WATERMARK) -> DataFrame:
    """The three alert kinds with one schema."""
    return (velocity_alerts(txns, width, more_than, delay)
            .unionByName(distance_alerts(txns, seconds, km, delay))
            .unionByName(amount_alerts(txns, averages, factor)))
