"""Mergeable count / mean / spread summaries of a price column.

A summary keeps n, mean, m2 (sum of squared distances from the mean) and the
extremes. Merging summaries never subtracts large sums of squares, and equal
extremes tell a constant price apart from rounding noise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("n", "mean", "m2", "low", "high")


def summarize(value: Column) -> list[Column]:
    """Aggregates for ``groupBy().agg()``; all of them combine before the shuffle."""
    return [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    ]


def merged(parts: Column, finish=None) -> Column:
    """The summary of an array of summaries, merged in one pass in array order."""
    zero = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))

    def merge(acc, x):
        n = acc["n"] + x["n"]
        gap = x["mean"] - acc["mean"]
        both = F.struct(
            n.alias("n"),
            (acc["mean"] + gap * x["n"] / n).alias("mean"),
            (acc["m2"] + x["m2"] + gap * gap * acc["n"] * x["n"] / n).alias("m2"),
            F.least(acc["low"], x["low"]).alias("low"),
            F.greatest(acc["high"], x["high"]).alias("high"))
        return F.when(x["n"] > 0, both).otherwise(acc)

    return F.aggregate(parts, zero, merge, finish)


def merged_stats(parts: Column) -> Column:
    """Mean, sample stddev and count of an array of summaries."""
    def finish(acc):
        return F.struct(
            F.when(acc["n"] > 0, acc["mean"]).alias("mean_price"),
            sample_stddev(acc["n"], acc["m2"], acc["low"], acc["high"]).alias("stddev_price"),
            acc["n"].alias("count_trades"))

    return merged(parts, finish)


def sample_stddev(n: Column, m2: Column, low: Column, high: Column) -> Column:
    """Null below two values, exactly zero for a constant price."""
    return (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(low == high, F.lit(0.0))
        .otherwise(F.sqrt(F.try_divide(F.greatest(m2, F.lit(0.0)), n - 1)))
    )
