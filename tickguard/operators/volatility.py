"""Volatile windows: coefficient of variation above a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickguard.functions.scalars import is_number, volatility_ratio
from tickguard.operators.windows import (
    STATS, finished, inside, pane_summaries, sliding_stats, whole, window_bounds, window_starts)
from tickguard.params import VolatilityRule, WindowSpec

COLUMNS = ["window_start", "window_end", "symbol", "count_trades",
           "mean_price", "stddev_price", "volatility_ratio"]


def rated_windows(stats: DataFrame, rule: VolatilityRule) -> DataFrame:
    """Windows with enough trades and some spread, with their ratio."""
    valid = stats.filter(
        (F.col("count_trades") >= rule.min_trades)
        & is_number(F.col("stddev_price")) & (F.col("stddev_price") > 0))
    return valid.withColumn(
        "volatility_ratio", volatility_ratio(F.col("stddev_price"), F.col("mean_price")))


def over_threshold(rated: DataFrame, rule: VolatilityRule) -> DataFrame:
    return rated.filter(F.col("volatility_ratio") > rule.threshold)


def volatility_alerts(
    trades: DataFrame, spec: WindowSpec = WindowSpec(), rule: VolatilityRule = VolatilityRule(),
) -> DataFrame:
    return over_threshold(rated_windows(sliding_stats(trades, spec), rule), rule).select(*COLUMNS)


def revised_stats(trades: DataFrame, spec: WindowSpec, batch_s: int) -> DataFrame:
    """What an update-mode stream emits when it is fed one ``batch_s`` of event time at a time.

    Every batch that touches a window re-emits the window with all its trades so
    far. ``batch_id`` numbers the batches by event time; a batch must be a whole
    number of slides, so that a pane never spans two of them.
    """
    if spec.panes is None or batch_s % spec.slide_s:
        raise ValueError("the batch and the window must be whole numbers of slides")
    batch = whole(F.col("slot"), batch_s // spec.slide_s)
    panes = pane_summaries(trades, spec).withColumn("batch_id", batch)
    held = window_starts(panes, spec).select(
        "symbol", "start", inside("ahead", F.col("start"), spec).alias("parts"))
    batches = held.withColumn("batch_id", F.explode(F.array_distinct(F.col("parts.batch_id"))))
    stats = batches.select("batch_id", "symbol", "start", finished(
        F.filter("parts", lambda x: x["batch_id"] <= F.col("batch_id"))))
    return stats.select("batch_id", *window_bounds(F.col("start"), spec), *STATS[2:])
