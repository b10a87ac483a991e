"""Stream sources and sinks: message-broker options, file twins, checkpoints, running to the end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from brightledger.functions.dates import parse_event_time
from brightledger.operators.validation import error_rows, keyed_message, rejected_rows, valid_rows, validate

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Shape of a validated transaction on the wire: flat coordinates, typed numbers, time as text.
TRANSACTION_SCHEMA = """transaction_id string, timestamp string, customer_id string, merchant_id string,
merchant_category string, payment_method string, amount bigint, lat double, lng double,
device_info map<string, string>, status string, commission_type string, commission_amount bigint, vat_amount bigint,
total_amount bigint, customer_type string, risk_level int, failure_reason string"""


def broker_source_options(servers: str, topic: str, start: str = "earliest", group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    return options


def broker_sink_options(servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}


def broker_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Message values as text. Needs the public Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**broker_source_options(servers, topic)).load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival"))


def text_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """File twin of the broker source: one JSON message per line in column ``value``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table of a data folder read as a stream."""
    raw = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def parse_transactions(messages: DataFrame, schema: str = TRANSACTION_SCHEMA) -> DataFrame:
    """Typed columns and the event time ``ts``; a message that does not parse is left out."""
    d = messages.select(F.from_json("value", schema).alias("d")).select("d.*")
    return d.withColumn("ts", parse_event_time(F.col("timestamp"))).filter(F.col("ts").isNotNull())


def as_messages(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def sink(df: DataFrame, kind: str, checkpoint: str, mode: str = "append", path: str | None = None,
         options: dict[str, str] | None = None, name: str | None = None,
         on_batch: Callable[[DataFrame, int], None] | None = None, available_now: bool = True) -> StreamingQuery:
    """Start a query on a kafka, parquet, json, memory or per-batch sink with its own checkpoint."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    if options:
        w = w.options(**options)
    if kind == "batch":
        return w.foreachBatch(on_batch).start()
    w = w.format(kind)
    return w.start(path) if path else w.start()


def run_all(queries: list[StreamingQuery]) -> None:
    """Wait for every started query; a failed one raises after the others have ended."""
    failures = []
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            failures.append(q.exception())
    if failures:
        raise failures[0]


def run_to_table(df: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over all data present now and return its output as a table."""
    run_all([sink(df, "parquet", f"{folder}/checkpoint", mode, path=f"{folder}/output")])
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/output")


def upserts(df: DataFrame, folder: str, name: str | None = None) -> StreamingQuery:
    """Start a query in update mode whose batches are stored for ``upserted``.

    A batch is written under ``batch=<id>`` with overwrite, so a replayed batch replaces its own rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/output/batch={batch_id}")

    return sink(df, "batch", f"{folder}/checkpoint", "update", on_batch=write, name=name)


def upserted(spark: SparkSession, schema, folder: str, keys: list[str]) -> DataFrame:
    """The latest row of every key that an update-mode query has stored."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(f"{folder}/output")
    rest = [f.name for f in schema.fields if f.name not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(F.lit(0).alias("_"), *rest), "batch").alias("_r"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in schema.names])


def run_upserts(df: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """Run a stream in update mode over all data present now: every window, also those still open, with its latest values."""
    run_all([upserts(df, folder)])
    return upserted(df.sparkSession, df.schema, folder, keys)


def validation_stream(messages: DataFrame, valid_path: str, error_path: str, reject_path: str, checkpoint: str,
                      as_of=None) -> StreamingQuery:
    """Parse, check and split messages to three sinks: valid rows, one keyed error message per failed
    rule, and rejected text with its reason. ``as_of`` defaults to the arrival time.

    Each sink gets its batch under ``batch=<id>`` with overwrite, so a replayed batch replaces its
    own output and nothing is doubled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        arrival = as_of if as_of is not None else (
            F.col("arrival") if "arrival" in batch.columns else F.current_timestamp())
        checked = validate(batch, arrival).persist()
        try:
            for rows, path in ((valid_rows(checked).drop("errors", "reject_reason", "value"), valid_path),
                               (keyed_message(error_rows(checked), "transaction_id"), error_path),
                               (rejected_rows(checked), reject_path)):
                rows.write.mode("overwrite").json(f"{path}/batch={batch_id}")
        finally:
            checked.unpersist()

    return sink(messages, "batch", checkpoint, on_batch=write)
