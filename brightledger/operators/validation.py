"""Message validation: parse, required keys, rules as an array of codes, valid / invalid split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions.dates import outside_day_before, parse_event_time

# Keys a message must carry, device systems accepted, and the codes of the rules.
REQUIRED_KEYS = ["transaction_id", "timestamp", "customer_id", "merchant_id", "merchant_category", "payment_method",
                 "amount", "location", "device_info", "status", "commission_type", "commission_amount", "vat_amount",
                 "total_amount", "customer_type", "risk_level", "failure_reason"]
REQUIRED_LOCATION_KEYS = ["lat", "lng"]
DEVICE_SYSTEMS = ["iOS", "Android"]
AMOUNT_CODE, TIME_CODE, DEVICE_CODE = "ERR_AMOUNT", "ERR_TIME", "ERR_DEVICE"

# Every scalar is read as text and cast with try_cast, so one bad field cannot fail the job.
MESSAGE_SCHEMA = """transaction_id string, timestamp string, customer_id string, merchant_id string,
merchant_category string, payment_method string, amount string, location struct<lat: string, lng: string>,
device_info map<string, string>, status string, commission_type string, commission_amount string, vat_amount string,
total_amount string, customer_type string, risk_level string, failure_reason string, _corrupt_record string"""

_TEXT = ["transaction_id", "customer_id", "merchant_id", "merchant_category", "payment_method", "status",
         "commission_type", "customer_type", "failure_reason"]
_WHOLE = ["amount", "commission_amount", "vat_amount", "total_amount", "risk_level"]


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row.

    A plain projection would be inlined into every later filter and expression, parsing the
    text again each time; a generated row is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _first_missing(keys: Column, inner: Column) -> Column:
    """Name of the first required key that is absent; NULL when complete."""
    missing = F.concat(
        F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]), keys),
        F.array_except(F.array(*[F.lit(k) for k in REQUIRED_LOCATION_KEYS]),
                       F.coalesce(inner, F.array().cast("array<string>"))))
    return F.try_element_at(missing, F.lit(1))


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Flatten and cast; adds ``reject_reason`` (malformed, missing:<key>, cast:<column> or NULL)."""
    parsed = _once(df, {
        "_d": F.from_json(value, MESSAGE_SCHEMA, {"mode": "PERMISSIVE"}),
        "_keys": F.json_object_keys(value),
        "_inner": F.json_object_keys(F.get_json_object(value, "$.location"))})
    fields = {c: F.col(f"_d.{c}") for c in _TEXT}
    fields |= {c: F.col(f"_d.{c}").try_cast("bigint") for c in _WHOLE}
    fields |= {c: F.col(f"_d.location.{c}").try_cast("double") for c in REQUIRED_LOCATION_KEYS}
    fields |= {"device_info": F.col("_d.device_info"), "event_time": parse_event_time(F.col("_d.timestamp")),
               "_missing": _first_missing(F.col("_keys"), F.col("_inner"))}
    typed = _once(parsed, fields)
    malformed = F.col("_d._corrupt_record").isNotNull() | F.col("_d").isNull() | F.col("_keys").isNull()
    reason = F.when(malformed, "malformed").when(
        F.col("_missing").isNotNull(), F.concat(F.lit("missing:"), "_missing"))
    for c in [*_WHOLE, *REQUIRED_LOCATION_KEYS, "event_time"]:
        reason = reason.when(F.col(c).isNull(), F.lit(f"cast:{c}"))
    return typed.withColumn("reject_reason", reason).drop("_d", "_keys", "_inner", "_missing")


def rule_codes(as_of: Column) -> Column:
    """Codes of the failed rules, in the order amount, time, device."""
    amount = F.col("total_amount") != F.col("amount") + F.col("vat_amount") + F.col("commission_amount")
    system = F.try_element_at("device_info", F.lit("os"))
    device = (F.col("payment_method") == "mobile") & ~F.coalesce(system.isin(*DEVICE_SYSTEMS), F.lit(False))
    return F.array_compact(F.array(
        F.when(amount, AMOUNT_CODE), F.when(outside_day_before(F.col("event_time"), as_of), TIME_CODE),
        F.when(device, DEVICE_CODE)))


def validate(df: DataFrame, as_of: Column, value: str = "value") -> DataFrame:
    """Parsed messages with ``errors`` (array of codes) and ``arrival``, the time ``as_of`` that they were checked against."""
    parsed = parse_messages(df.withColumn("_as_of", as_of), value)
    return parsed.withColumn("errors", rule_codes(F.col("_as_of"))).withColumn("arrival", F.col("_as_of")).drop("_as_of")


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull() & (F.size("errors") == 0)).drop("arrival")


def error_rows(validated: DataFrame) -> DataFrame:
    """One row per failed rule, with the time of arrival."""
    return validated.filter(F.col("reject_reason").isNull() & (F.size("errors") > 0)).select(
        "transaction_id", F.explode("errors").alias("error_code"), F.col("arrival").alias("timestamp"))


def rejected_rows(validated: DataFrame, value: str = "value") -> DataFrame:
    return validated.filter(F.col("reject_reason").isNotNull()).select(F.col(value).alias("value"), "reject_reason")


def keyed_message(df: DataFrame, key: str) -> DataFrame:
    """(key, value) pairs for a keyed message sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
