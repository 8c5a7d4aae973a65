"""Mergeable price and symbol sketches as a stored table, one row per batch, day and symbol.

A quantile sketch holds the prices, a HyperLogLog sketch whatever is to be counted
distinct, next to exact counts and extremes. Any range of days is answered by merging the
few stored rows, without the trades. Sketches merge in any order.

The rank of an estimated quantile is off by at most ``RANK_ERROR`` with a probability of over
99 per cent (the bound of the sketch for ``ITEMS`` is below half of it); a distinct count by
three standard errors, 3 * 1.04 / sqrt(2 ** ``LG_REGISTERS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickguard.functions.scalars import number
from tickguard.session import folder_exists

ITEMS, RANK_ERROR = 800, 0.01
LG_REGISTERS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_REGISTERS / 2)
STORED = ("day date, symbol string, prices binary, distinct_of binary, n long, low double, high double, "
          "batch_id long")


def summarize(trades: DataFrame, distinct: str | None = None) -> DataFrame:
    """One row per day and symbol, combined before the shuffle; a NaN price is missing.

    ``distinct`` names the column to count distinct. Trades without a time or a price take no part.
    """
    priced = trades.withColumn("price", number(F.col("price"))).filter("price is not null and event_time is not null")
    counted = F.hll_sketch_agg(F.col(distinct).cast("string"), LG_REGISTERS) if distinct else F.first(F.lit(None).cast("binary"))
    return priced.groupBy(F.to_date("event_time").alias("day"), "symbol").agg(
        F.kll_sketch_agg_double("price", F.lit(ITEMS)).alias("prices"), counted.alias("distinct_of"),
        F.count(F.lit(1)).alias("n"), F.min("price").alias("low"), F.max("price").alias("high"))


def add_batch(trades: DataFrame, root: str, batch_id: int, distinct: str | None = None) -> None:
    """Replace the batch's rows in the store; a replayed batch is not counted twice."""
    (summarize(trades, distinct).hint("rebalance")
     .write.mode("overwrite").partitionBy("day").parquet(f"{root}/batch_id={batch_id}"))


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The stored rows; a filter on ``day`` or ``batch_id`` prunes the folders read."""
    if not folder_exists(spark, root):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(root)


def merged(store: DataFrame, *by: str | Column) -> DataFrame:
    """The store's rows merged per ``by``: prices, distinct_of, n, low and high."""
    return store.groupBy(*by).agg(
        F.kll_merge_agg_double("prices").alias("prices"),
        F.hll_union_agg("distinct_of").alias("distinct_of"),
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def between(store: DataFrame, first: str, last: str) -> DataFrame:
    """The rows of the days from ``first`` to ``last``, both included."""
    return store.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def quantile(share: float) -> Column:
    return F.kll_sketch_get_quantile_double("prices", F.lit(float(share)))


def box(store: DataFrame, *by: str | Column) -> DataFrame:
    """Exact counts and extremes with estimated quartiles, per ``by``."""
    return merged(store, *by).select(
        *by, "n", "low", quantile(0.25).alias("q1"), quantile(0.5).alias("median"), quantile(0.75).alias("q3"), "high")


def histogram(store: DataFrame, bins: int = 30) -> DataFrame:
    """Estimated counts in ``bins`` equal bins over [low, high]; equal values all go to bin 1.

    Sketches are asked for the ranks of fixed values, so the two ends are looked up first.
    """
    low, high = store.agg(F.min("low"), F.max("high")).first()
    if low is None:
        return store.select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_from"), F.lit(0.0).alias("bin_to"),
                            F.lit(0.0).alias("trades")).limit(0)
    edges = [low + (high - low) * k / bins for k in range(bins)] + [high]
    upto = [F.lit(0.0)] + [F.lit(1.0) if edge == high else F.kll_sketch_get_rank_double("prices", F.lit(edge))
                           for edge in edges[1:]]
    rows = [F.struct(F.lit(k + 1).alias("bin"), F.lit(edges[k]).alias("bin_from"), F.lit(edges[k + 1]).alias("bin_to"),
                     (F.col("n") * (upto[k + 1] - upto[k])).alias("trades")) for k in range(bins)]
    return merged(store).select(F.inline(F.array(*rows)))


def distinct_count(store: DataFrame, *by: str | Column) -> DataFrame:
    return merged(store, *by).select(*by, F.hll_sketch_estimate("distinct_of").alias("distinct"))
