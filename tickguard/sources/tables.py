"""The event table seen as trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = ("event_id bigint, ts timestamp_ntz, user_id bigint, "
          "event_type string, value double, props string")


def _as_trades(events: DataFrame, symbol: Column) -> DataFrame:
    return events.select(
        "event_id",
        symbol.alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("ts").cast("timestamp").alias("event_time"))


def events_as_trades(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return _as_trades(events, F.col(symbol).cast("string"))


def stream_events_as_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a stream takes a lone file only by pattern; it fits a folder too.
    events = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")
    return _as_trades(events, F.col("event_type"))
