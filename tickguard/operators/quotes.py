"""Daily quote snapshot per symbol, computed from the trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickguard.functions.scalars import number
from tickguard.operators.attach import attach

COLUMNS = ["symbol", "day", "c", "pc", "o", "h", "l", "d", "dp"]


def quote_snapshot(trades: DataFrame, tie: tuple[str, ...] = ("price", "volume")) -> DataFrame:
    """Last, previous close, open, high, low, change and change % per symbol and day.

    ``tie`` orders trades of one instant. The window only sees one row per
    symbol and day.
    """
    priced = (
        trades.withColumn("price", number(F.col("price")))
        .filter(F.col("symbol").isNotNull() & F.col("event_time").isNotNull()
                & F.col("price").isNotNull())
        .withColumns({"day": F.to_date("event_time"), "_at": F.unix_micros("event_time")}))
    # Numbers alone combine in a hash before the shuffle; only the trades of a day's
    # first and last instant are then looked at one by one.
    spans = priced.groupBy("symbol", "day").agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.max("price").alias("h"),
        F.min("price").alias("l"), F.count(F.lit(1)).alias("_trades"))
    ends = (attach(priced, spans, ["symbol", "day"], "_trades")
            .filter((F.col("_at") == F.col("_first")) | (F.col("_at") == F.col("_last"))))
    place = F.struct("_at", *tie)
    days = ends.groupBy("symbol", "day", "h", "l").agg(
        F.max_by("price", place).alias("c"), F.min_by("price", place).alias("o"))
    previous = F.lag("c").over(Window.partitionBy("symbol").orderBy("day"))
    change = F.col("c") - F.col("pc")
    return (
        days.withColumn("pc", previous)
        .withColumn("d", change)
        .withColumn("dp", F.try_divide(100 * change, F.col("pc")))
        .select(*COLUMNS)
    )
