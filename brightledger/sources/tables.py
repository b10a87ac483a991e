"""Typed loaders. Schemas are given, so no inference job runs and scans stay pruned."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.sources import views

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

TIME_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
    time_column = TIME_COLUMNS.get(name)
    if time_column:
        # watermarks accept only the zoned timestamp type
        df = df.withColumn(time_column, F.col(time_column).cast("timestamp"))
    return df


class Tables:
    """The base tables and derived views of one data folder, loaded on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        df = load_table(self.spark, self.folder, name)
        self.__dict__[name] = df
        return df

    @cached_property
    def txn(self) -> DataFrame:
        return views.transactions(self.events)

    @cached_property
    def txn_json(self) -> DataFrame:
        return views.transaction_messages(self.events)

    @cached_property
    def events_with_gaps(self) -> DataFrame:
        return views.events_with_gaps(self.events)

    @cached_property
    def boxes(self) -> DataFrame:
        return views.boxes(self.lineitem)

    @cached_property
    def ratings(self) -> DataFrame:
        return views.ratings(self.orders, self.lineitem)

    @cached_property
    def edges(self) -> DataFrame:
        return views.edges(self.customer)

    @cached_property
    def ohlcv(self) -> DataFrame:
        return views.daily_bars(self.orders)

    @cached_property
    def polls(self) -> DataFrame:
        return views.polls(self.orders)

    @cached_property
    def qa(self) -> DataFrame:
        return views.question_answers(self.conversations)

    @cached_property
    def probs(self) -> DataFrame:
        return views.class_probabilities(self.embeddings)
