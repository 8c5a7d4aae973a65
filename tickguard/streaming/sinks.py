"""Sinks for alerts, raw trades and keyed messages."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickguard.session import remove_folder, settle
from tickguard.sources.trades import to_raw

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SUMMARY = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("written_at", T.TimestampType()),
    T.StructField("analysed", T.LongType()),
    T.StructField("alerts", T.LongType()),
    T.StructField("max_measure", T.DoubleType()),
])


def write_alerts(alerts: DataFrame, root: str, batch_id: int) -> None:
    """Replace the ``batch_id`` folder of ``root`` with these alerts.

    A batch without alerts leaves no folder, also if an earlier run of the batch
    had some. Other batches are not touched. Small alert partitions are merged
    into few files and large ones kept apart by the rebalance hint.
    """
    folder, seen = f"{root}/batch_id={batch_id}", Observation("written")
    (alerts.drop("batch_id").observe(seen, F.count(F.lit(1)).alias("rows"))
     .hint("rebalance")
     .write.mode("overwrite").option("header", "true").option("timestampFormat", STAMP).csv(folder))
    if not seen.get.get("rows"):
        remove_folder(alerts.sparkSession, folder)


def write_summary(counts: dict, root: str, batch_id: int, spark) -> None:
    row = Row(batch_id=batch_id, written_at=datetime.now(UTC), analysed=counts["analysed"],
              alerts=counts["alerts"],
              max_measure=None if counts["alerts"] else counts["max_measure"])
    (spark.createDataFrame([row], SUMMARY).coalesce(1)
     .write.mode("overwrite").json(f"{root}/batch={batch_id}"))


def observed(df: DataFrame, measure: str, threshold: float) -> tuple[DataFrame, Observation]:
    """Count analysed and alerting rows while they pass, without a second read."""
    seen = Observation("batch")
    value = F.expr(measure)
    return df.observe(
        seen, F.count(F.lit(1)).alias("analysed"), F.count_if(value > threshold).alias("alerts"),
        F.max(value).alias("max_measure")), seen


def export_csv(alerts: DataFrame, folder: str, stamp: str) -> str:
    path = f"{folder}/anomalies_{stamp}"
    (alerts.write.mode("errorifexists").option("header", "true")
     .option("timestampFormat", STAMP).csv(path))
    return path


def write_lines(trades: DataFrame, path: str, mode: str = "append") -> None:
    to_raw(trades).write.mode(mode).json(path)


def stream_to_lines(trades: DataFrame, path: str, checkpoint: str):
    """The relay's lots: JSON-lines files that appear only when complete."""
    return (to_raw(trades).writeStream.format("json")
            .option("path", path).option("checkpointLocation", checkpoint))


def keyed_messages(trades: DataFrame, *keep: str) -> DataFrame:
    """key and value of the keyed stream: the key is the symbol."""
    raw = to_raw(trades, *keep)
    return raw.select(F.col("s").alias("key"),
                      F.to_json(F.struct("s", "p", "v", "t", "c")).alias("value"), *keep)


def in_symbol_order(trades: DataFrame, *ties: str) -> DataFrame:
    """Trades laid out so that each symbol is in time order, from partition to partition.

    Partitions are ranges of (symbol, time): one symbol may fill several of
    them, in order, so a busy symbol does not end up in a single task. Equal
    trades are told apart by their place in a written copy, so they may be split
    too, and a retried task deals them the same way.
    """
    order = ["symbol", "event_time", *ties]
    return (settle(trades, "layout").withColumn("_turn", F.monotonically_increasing_id())
            .repartitionByRange(*order, "_turn")
            .sortWithinPartitions(*order).drop("_turn"))


def numbered(trades: DataFrame, *ties: str) -> DataFrame:
    """``trades`` with ``sequence``: 1, 2, ... per symbol, in the order of time and then ``ties``.

    Two levels of ranks: the layout cuts (symbol, time) into ranges, a range's places are its own
    ranks, and the trades of a symbol in the ranges before it are counted. A busy symbol fills many
    ranges, so no task holds it; only one row per range and symbol is ranked on its own. Trades
    without a symbol are numbered among themselves, those without a time come first.
    """
    laid = settle(in_symbol_order(trades, *ties).withColumns(
        {"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), "ranges")
    ranges = laid.groupBy("symbol", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("symbol").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(ranges.select("symbol", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0))
                                                      - F.col("_first") + 1).alias("_shift"), "_rows"), "starts")
    # A range of a symbol has a bounded number of trades, so the join's groups are bounded too.
    same = laid["symbol"].eqNullSafe(starts["symbol"]) & (laid["_part"] == starts["_part"])
    return laid.join(starts, same).select(
        *[laid[c] for c in trades.columns], (F.col("_place") + F.col("_shift")).alias("sequence"))


def publish(trades: DataFrame, servers: str, topic: str, *ties: str) -> None:
    """Send keyed messages in symbol order; needs Spark's Kafka package on the cluster.

    The key sends a symbol's messages to one partition of the topic. They are
    laid out in symbol order first, so those of one task arrive in order. A symbol that
    fills several tasks is sent by them at the same time; each message therefore carries
    its number in the symbol's order in the header ``sequence``, gapless from 1, by which
    a reader restores the order.
    """
    messages = keyed_messages(numbered(trades, *ties), "sequence")
    header = F.array(F.struct(F.lit("sequence").alias("key"), F.col("sequence").cast("string").cast("binary").alias("value")))
    (messages.select("key", "value", header.alias("headers")).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).option("includeHeaders", "true").save())
