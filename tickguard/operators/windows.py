"""Sliding-window price statistics per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec as WindowFrame

from tickguard.functions import moments as M
from tickguard.functions.scalars import number
from tickguard.params import MICROS, WindowSpec

STATS = ["window_start", "window_end", "symbol", "mean_price", "stddev_price", "count_trades"]


def slot_of(time: Column, slide_s: int) -> Column:
    """Number of the slide-long pane that holds ``time``, counted from the epoch."""
    return whole(F.unix_micros(time), slide_s * MICROS)


def whole(number: Column, unit: int) -> Column:
    """Floor division of a long column, exact below the epoch too."""
    return ((number - F.pmod(number, F.lit(unit))) / F.lit(unit)).cast("long")


def slot_start(slot: Column, slide_s: int) -> Column:
    return F.timestamp_seconds(slot * F.lit(slide_s))


def pane_summaries(trades: DataFrame, spec: WindowSpec) -> DataFrame:
    """One summary per (symbol, slot).

    Trades without an event time belong to no window.
    """
    return (
        trades.filter(F.col("event_time").isNotNull())
        .groupBy("symbol", slot_of(F.col("event_time"), spec.slide_s).alias("slot"))
        .agg(*M.summarize(number(F.col("price"))))
    )


def beside_neighbours(panes: DataFrame, spec: WindowSpec) -> tuple[DataFrame, WindowFrame]:
    """Lay panes out in blocks of time, each with a margin of one window on both sides.

    A symbol's panes are cut into many groups of bounded size, so a symbol with
    a long history is not one task's work. Only a few panes per block are copied.
    """
    reach = spec.panes - 1
    block = max(16, 10 * spec.panes)
    homes = F.array_distinct(F.array(*[
        whole(F.col("slot") + shift, block) for shift in (-reach, 0, reach)]))
    laid_out = panes.withColumn("home", F.explode(homes)).withColumn(
        "own", whole(F.col("slot"), block) == F.col("home"))
    return laid_out, Window.partitionBy("symbol", "home").orderBy("slot")


def window_starts(panes: DataFrame, spec: WindowSpec) -> DataFrame:
    """Every window that holds a pane, once: its ``start`` and the panes ``ahead``.

    A window is built at the first pane it holds: those are the windows that
    start after the symbol's previous pane.
    """
    reach = spec.panes - 1
    rows, near = beside_neighbours(panes, spec)
    fields = [c for c in panes.columns if c != "symbol"]
    earliest = F.col("slot") - reach
    starts = F.sequence(
        F.greatest(earliest, F.coalesce(F.col("before") + 1, earliest)), F.col("slot"))
    return (
        rows.withColumns({
            "before": F.lag("slot").over(near),
            "ahead": F.collect_list(F.struct(*fields)).over(near.rangeBetween(0, reach))})
        .filter("own")
        .select("symbol", "ahead", F.explode(starts).alias("start"))
    )


def inside(panes: Column | str, start: Column, spec: WindowSpec) -> Column:
    return F.filter(panes, lambda x: x["slot"].between(start, start + (spec.panes - 1)))


def finished(parts: Column) -> Column:
    """The merged statistics as columns.

    Being a generator, it hands finished values to later filters, which on a
    plain projection would repeat the merge.
    """
    return F.inline(F.array(M.merged_stats(parts)))


def sliding_stats(trades: DataFrame, spec: WindowSpec) -> DataFrame:
    """Mean, sample stddev and count per (window, symbol).

    Tables are summarized per pane first: the shuffle that grows with the trades
    carries one partial row per task, symbol and pane instead of one per window,
    and the panes then move once more, nearly uncopied, to be merged into
    windows. Streams, and slides that do not divide the window, use Spark's own
    windows.
    """
    if trades.isStreaming or spec.panes in (None, 1):
        return direct_sliding_stats(trades, spec)
    windows = window_starts(pane_summaries(trades, spec), spec)
    stats = windows.select("symbol", "start", finished(inside("ahead", F.col("start"), spec)))
    return stats.select(*window_bounds(F.col("start"), spec), *STATS[2:])


def window_bounds(start: Column, spec: WindowSpec) -> list[Column]:
    return [slot_start(start, spec.slide_s).alias("window_start"),
            slot_start(start + spec.panes, spec.slide_s).alias("window_end")]


def windowed_stats(trades: DataFrame, spec: WindowSpec) -> DataFrame:
    """Spark's own sliding windows; the window column keeps a stream's watermark."""
    price = number(F.col("price"))
    return trades.groupBy(F.window("event_time", spec.length, spec.slide), "symbol").agg(
        F.avg(price).alias("mean_price"),
        F.stddev_samp(price).alias("stddev_price"),
        F.count(price).alias("count_trades"))


def direct_sliding_stats(trades: DataFrame, spec: WindowSpec) -> DataFrame:
    return windowed_stats(trades, spec).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *STATS[2:])


def windows_per_pane(trades: DataFrame, spec: WindowSpec) -> DataFrame:
    """Per (symbol, slot): the statistics of the windows that cover it, as an array.

    ``pane_trades`` counts the trades of the pane itself; ``low`` and ``high`` are its extremes.
    """
    reach = spec.panes - 1
    rows, near = beside_neighbours(pane_summaries(trades, spec), spec)
    around = F.collect_list(F.struct("slot", *M.FIELDS)).over(near.rangeBetween(-reach, reach))
    starts = F.sequence(F.col("slot") - reach, F.col("slot"))
    merged = F.transform(starts, lambda start: F.struct(
        start.alias("start"), M.merged_stats(inside("around", start, spec)).alias("stats")))
    windows = F.transform(merged, lambda w: F.struct(
        *window_bounds(w["start"], spec), *[w["stats"][c].alias(c) for c in STATS[3:]]))
    return (
        rows.withColumn("around", around).filter("own").filter(F.col("n") > 0)
        .select("symbol", "slot", F.col("n").alias("pane_trades"), "low", "high",
                F.inline(F.array(F.struct(windows.alias("windows")))))
    )
