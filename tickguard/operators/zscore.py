"""Outlying trades: z-scores against a batch or against sliding windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickguard.functions.scalars import is_number, number, z_score
from tickguard.operators.attach import attach
from tickguard.operators.windows import slot_of, windows_per_pane
from tickguard.params import WindowSpec, ZScoreRule

COLUMNS = ["event_time", "symbol", "price", "volume",
           "mean_price", "stddev_price", "count_trades", "z_score"]


def usable(stats: DataFrame, rule: ZScoreRule) -> DataFrame:
    """Groups with a symbol, enough trades and some spread."""
    return stats.filter(
        F.col("symbol").isNotNull() & (F.col("count_trades") >= rule.min_trades)
        & is_number(F.col("stddev_price")) & (F.col("stddev_price") > 0))


def scored(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "z_score", z_score(F.col("price"), F.col("mean_price"), F.col("stddev_price")))


def outliers(df: DataFrame, rule: ZScoreRule) -> DataFrame:
    return df.filter(is_number(F.col("z_score")) & (F.abs("z_score") > rule.threshold))


def batch_stats(trades: DataFrame, keys: list[str]) -> DataFrame:
    return trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_trades"),
        F.avg("price").alias("mean_price"),
        F.stddev_samp("price").alias("stddev_price"),
        F.count("price").alias("count_trades"),
        F.min("price").alias("lowest"), F.max("price").alias("highest"))


def band_edge(mean: Column, stddev: Column, rule: ZScoreRule, side: int) -> Column:
    """Where alerts may begin above (1) or below (-1) the mean.

    Nearer to the mean than the exact edge by more than rounding can amount to,
    so that the band never hides an alert; the exact test follows.
    """
    return mean + side * (rule.threshold * (1 - 1e-9) * stddev - F.abs(mean) * 1e-12)


def score_batch(
    trades: DataFrame, rule: ZScoreRule = ZScoreRule(), batch: str | None = None, **sizes,
) -> DataFrame:
    """Every trade of a usable group, with the group's statistics and its z-score.

    A group is one symbol of the whole input, or of each value of the ``batch``
    column. The statistics come from a map-side combined aggregate and return to
    the trades by ``attach``; no task ever holds all trades of a symbol.
    """
    keys = ["symbol"] if batch is None else [batch, "symbol"]
    return _scored_batch(trades, rule, keys, None, sizes)


def _scored_batch(trades: DataFrame, rule: ZScoreRule, keys: list[str], which, sizes) -> DataFrame:
    trades = trades.withColumn("price", number(F.col("price")))
    stats = usable(batch_stats(trades, keys), rule)
    if which is not None:
        stats = stats.filter(which)
    stats = stats.drop("lowest", "highest")
    return scored(attach(trades, stats, keys, "group_trades", **sizes).drop("group_trades"))


def batch_zscores(
    trades: DataFrame, rule: ZScoreRule = ZScoreRule(), batch: str | None = None, **sizes,
) -> DataFrame:
    """The alerting trades. Groups whose extremes stay inside the band are left out of the join."""
    mean, stddev = F.col("mean_price"), F.col("stddev_price")
    alerting = ((F.col("highest") > band_edge(mean, stddev, rule, 1))
                | (F.col("lowest") < band_edge(mean, stddev, rule, -1)))
    keys = ["symbol"] if batch is None else [batch, "symbol"]
    return outliers(_scored_batch(trades, rule, keys, alerting, sizes), rule)


def sliding_zscores(
    trades: DataFrame, spec: WindowSpec = WindowSpec(), rule: ZScoreRule = ZScoreRule(), **sizes,
) -> DataFrame:
    """Each trade against every sliding window that contains it.

    The trade meets its pane once, and the pane carries the statistics of its
    windows (length / slide of them), so the trades are not multiplied before
    the join. The pane also carries the tightest band of those windows: a trade
    inside it alerts nowhere, and only the others look at the windows one by one.
    """
    if spec.panes is None:
        raise ValueError("the window must be a whole number of slides")

    fit = F.filter("windows", lambda w: (
        (w["count_trades"] >= rule.min_trades) & (w["stddev_price"] > 0)))
    panes = (
        windows_per_pane(trades, spec).filter(F.col("symbol").isNotNull())
        .withColumn("windows", fit).filter(F.size("windows") > 0)
        .withColumns({
            "top": F.array_min(F.transform("windows", lambda w: band_edge(w["mean_price"], w["stddev_price"], rule, 1))),
            "bottom": F.array_max(F.transform("windows", lambda w: band_edge(w["mean_price"], w["stddev_price"], rule, -1)))})
        # A pane with no trade outside its band is not worth a join.
        .filter((F.col("low") < F.col("bottom")) | (F.col("high") > F.col("top")))
        .drop("low", "high"))
    facts = (
        trades.filter(F.col("event_time").isNotNull())
        .withColumn("price", number(F.col("price")))
        .withColumn("slot", slot_of(F.col("event_time"), spec.slide_s)))
    joined = attach(facts, panes, ["symbol", "slot"], "pane_trades", **sizes).filter(
        (F.col("price") > F.col("top")) | (F.col("price") < F.col("bottom")))
    own = [c for c in facts.columns if c != "slot"]
    return outliers(scored(joined.select(*own, F.inline("windows"))), rule)
