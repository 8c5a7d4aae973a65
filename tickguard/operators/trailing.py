"""Z-score of a trade against the same symbol's trades in the trailing duration.

The trailing range of a trade at time t is [t - span, t]. Time is cut into
blocks, ``blocks`` to a span, so the range is made of three parts: the end of
the block holding t - span, the whole blocks between, and the start of the block
holding t. The first and last parts are running summaries inside one block, in
opposite directions; the middle part is made of totals of dyadic stretches, a
logarithm of ``blocks`` for each block that has trades. So no frame is
ever re-read row by row, no sparse symbol pays for the short blocks of a busy one,
and no task needs more of a symbol than one block of distinct instants. ``fitting_blocks`` makes the blocks short enough for the
busiest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickguard.functions import moments as M
from tickguard.functions.scalars import number
from tickguard.operators.attach import attach
from tickguard.operators.zscore import outliers, scored
from tickguard.params import MICROS, ZScoreRule

OWN, TOTAL, LEAVING = 0, 1, 2
ROWS_PER_BLOCK = 4_000_000
MIN_BLOCKS, MAX_BLOCKS = 6, 1200


def priced(trades: DataFrame) -> DataFrame:
    return (
        trades.filter(F.col("symbol").isNotNull() & F.col("event_time").isNotNull())
        .withColumn("price", number(F.col("price"))).filter(F.col("price").isNotNull()))


def block_of(at: Column, block_us: int) -> Column:
    """Whole-number division, exact for times before the epoch too."""
    return ((at - F.pmod(at, F.lit(block_us))) / F.lit(block_us)).cast("long").alias("block")


def instants(trades: DataFrame, block_us: int) -> DataFrame:
    """One price summary per symbol and instant, combined before the shuffle."""
    at = F.unix_micros("event_time")
    return (
        priced(trades).groupBy("symbol", at.alias("at"), block_of(at, block_us))
        .agg(*M.summarize(F.col("price"))))


def fitting_blocks(trades: DataFrame, span_s: int, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    """Blocks per span that leave about ``rows_per_block`` trades in the busiest block."""
    span_us = span_s * MICROS
    at = F.unix_micros("event_time")
    busiest = (
        trades.filter(F.col("symbol").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("symbol", block_of(at, span_us // MIN_BLOCKS)).count()
        .agg(F.max("count")).first()[0] or 0)
    wanted = min(MAX_BLOCKS, MIN_BLOCKS * -(-busiest // rows_per_block))
    return next(b for b in range(max(MIN_BLOCKS, wanted), span_us + 1) if span_us % b == 0)


def stretches(lo: Column, hi: Column, blocks: int) -> Column:
    """The dyadic stretches that make up blocks ``lo`` to ``hi - 1``, fewer than ``blocks`` of them.

    Stretch ``i`` of level k holds blocks i * 2^k to (i + 1) * 2^k - 1. A level gives at most one
    stretch at each end: where its first whole stretch is odd, or its last one is even.
    """
    ends = []
    for k in range((blocks - 1).bit_length()):
        first, behind = F.shiftright(lo + ((1 << k) - 1), k), F.shiftright(hi, k)
        for odd, place in ((first, first), (behind, behind - 1)):
            ends.append(F.when((first < behind) & (F.pmod(odd, F.lit(2)) == 1), F.struct(
                F.lit(k).alias("level"), place.alias("stretch"))))
    return F.filter(F.array(*ends), lambda x: x.isNotNull())


def between_totals(totals: DataFrame, blocks: int) -> DataFrame:
    """Summaries that make up the ``blocks - 1`` blocks before each block of ``totals``.

    ``totals`` has one row per symbol and block with trades. Each is in one stretch a level,
    and each asks for two stretches a level at most, whatever the number of blocks.
    """
    levels = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("block", k).alias("stretch"))
                       for k in range((blocks - 1).bit_length())])
    held = totals.select("symbol", F.struct(*M.FIELDS).alias("part"), F.inline(levels))
    # A list has at most as many parts as its stretch has blocks, fewer than ``blocks``.
    sums = (held.groupBy("symbol", "level", "stretch").agg(M.merged(F.collect_list("part")).alias("sum"))
            .select("symbol", "level", "stretch", "sum.*"))
    asked = totals.select("symbol", "block", F.inline(stretches(F.col("block") - (blocks - 1), F.col("block"), blocks)))
    return asked.join(sums, ["symbol", "level", "stretch"]).select("symbol", "block", *M.FIELDS)


def trailing_stats(trades: DataFrame, span_s: int, blocks: int | None = None) -> DataFrame:
    """Statistics of the trailing range at every (symbol, instant).

    ``n``, ``low`` and ``high`` describe the trades of the instant itself.
    """
    blocks = blocks or fitting_blocks(trades, span_s)
    span_us = span_s * MICROS
    if span_us % blocks:
        raise ValueError("the span must be a whole number of blocks")
    block_us = span_us // blocks
    ticks = instants(trades, block_us)

    def placed(role, block, at):
        return F.struct(F.lit(role).alias("role"), block.alias("block"), at.alias("at"))

    entering_and_leaving = ticks.select(
        "symbol", *M.FIELDS,
        F.inline(F.array(
            placed(OWN, F.col("block"), F.col("at")),
            placed(LEAVING, F.col("block") + blocks, F.col("at") + span_us))))
    rows = entering_and_leaving
    if blocks > 1:
        totals = (
            priced(trades).groupBy("symbol", block_of(F.unix_micros("event_time"), block_us))
            .agg(*M.summarize(F.col("price"))))
        between = between_totals(totals, blocks).withColumns(
            {"role": F.lit(TOTAL), "at": F.col("block") * block_us - 1})
        rows = rows.unionByName(between)

    group = Window.partitionBy("symbol", "block")
    forward = group.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    backward = group.orderBy(F.desc("at")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    leaving = F.col("role") == LEAVING

    def both_ways(agg, value, merge):
        return merge(agg(F.when(~leaving, value)).over(forward),
                     agg(F.when(leaving, value)).over(backward))

    def plus(a, b):
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))

    centre = F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group)
    gap = F.col("mean") - F.col("centre")
    ranged = (
        rows.withColumn("centre", centre)
        .withColumns({"s1": F.col("n") * gap, "s2": F.col("m2") + F.col("n") * gap * gap})
        .withColumns({
            "range_n": both_ways(F.sum, F.col("n"), plus),
            "range_s1": both_ways(F.sum, F.col("s1"), plus),
            "range_s2": both_ways(F.sum, F.col("s2"), plus),
            "range_low": both_ways(F.min, F.col("low"), F.least),
            "range_high": both_ways(F.max, F.col("high"), F.greatest)})
        .filter(F.col("role") == OWN)
    )
    shift = F.try_divide(F.col("range_s1"), F.col("range_n"))
    m2 = F.col("range_s2") - F.col("range_s1") * shift
    return ranged.select(
        "symbol", F.timestamp_micros("at").alias("event_time"), "n", "low", "high",
        F.when(F.col("range_low") == F.col("range_high"), F.col("range_low"))
        .otherwise(F.col("centre") + shift).alias("mean_price"),
        M.sample_stddev(F.col("range_n"), m2, F.col("range_low"), F.col("range_high"))
        .alias("stddev_price"),
        F.col("range_n").alias("count_trades"))


def trailing_zscores(
    trades: DataFrame, span_s: int, rule: ZScoreRule = ZScoreRule(), blocks: int | None = None,
    **sizes,
) -> DataFrame:
    """Trades outside ``threshold`` deviations of their own trailing range.

    An instant whose extremes stay inside the band cannot alert, so only the
    others are joined back to the trades.
    """
    reach = F.lit(rule.threshold) * F.col("stddev_price")
    # The band is widened a little, so that rounding in this pre-filter cannot
    # lose a trade which the exact test below would keep.
    slack = F.lit(1 - 1e-9)
    suspects = trailing_stats(trades, span_s, blocks).filter(
        (F.col("count_trades") >= rule.min_trades) & (F.col("stddev_price") > 0)
        & ((F.col("high") - F.col("mean_price") > reach * slack)
           | (F.col("mean_price") - F.col("low") > reach * slack))
    ).drop("low", "high")
    joined = attach(trades.withColumn("price", number(F.col("price"))), suspects,
                    ["symbol", "event_time"], "n", **sizes).drop("n")
    return outliers(scored(joined), rule)
