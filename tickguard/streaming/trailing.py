"""Z-scores against the trailing range, on streams.

Time is cut into blocks, ``blocks`` to a span. The group of a (symbol, block, salt) keeps the
block's own trades of that salt, the prices that may still leave the range, from the block a span
earlier, and every price of the block itself; of the blocks between it keeps one summary. It
fires when the watermark passes the block's end, and its state goes: no state is older than
a span, a block and the lateness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickguard.functions.scalars import number
from tickguard.operators.zscore import outliers, scored, usable
from tickguard.params import MICROS, ZScoreRule

OWN, INSIDE, BETWEEN, LEAVING = 0, 1, 2, 3
SUMMARY = ("n", "mean", "m2", "low", "high")
STATE = "own binary, inside binary, leaving binary, n long, mean double, m2 double, low double, high double"
_TICK = np.dtype([("at", np.int64), ("price", np.float64)])
_TRADE = np.dtype([("at", np.int64), ("price", np.float64), ("volume", np.float64), ("id", np.int64)])


def _merge(a: tuple, b: tuple) -> tuple:
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, gap = a[0] + b[0], b[1] - a[1]
    return (n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n, min(a[3], b[3]), max(a[4], b[4]))


def _summary(prices: np.ndarray) -> tuple:
    if not len(prices):
        return 0, 0.0, 0.0, np.inf, -np.inf
    mean = prices.mean()
    return len(prices), float(mean), float(((prices - mean) ** 2).sum()), float(prices.min()), float(prices.max())


def _trailing(own: np.ndarray, inside: np.ndarray, leaving: np.ndarray, between: tuple, span: int) -> pd.DataFrame:
    """Mean, deviation and count of the range [t - span, t] of every own trade."""
    parts = [p["price"] for p in (inside, leaving)]
    centre = np.concatenate(parts).mean() if sum(map(len, parts)) else 0.0
    if between[0]:
        centre = between[1]

    def running(ticks: np.ndarray, at: np.ndarray, backward: bool):
        """Count, sums around the centre and extremes of the ticks up to, or from, each time."""
        ticks = np.sort(ticks, order="at")
        gap = ticks["price"] - centre
        cut = np.searchsorted(ticks["at"], at, side="left" if backward else "right")
        if backward:
            turned, cut = slice(None, None, -1), len(ticks) - cut
        else:
            turned = slice(None)
        zero = np.zeros(1)
        s1, s2 = (np.concatenate((zero, np.cumsum(v[turned])))[cut] for v in (gap, gap * gap))
        low = np.concatenate((zero + np.inf, np.minimum.accumulate(ticks["price"][turned])))[cut]
        high = np.concatenate((zero - np.inf, np.maximum.accumulate(ticks["price"][turned])))[cut]
        return cut, s1, s2, low, high

    n1, a1, b1, low1, high1 = running(inside, own["at"], False)
    n2, a2, b2, low2, high2 = running(leaving, own["at"] - span, True)
    n0, mean0, m0, low0, high0 = between
    gap0 = mean0 - centre if n0 else 0.0
    n = n0 + n1 + n2
    s1 = n0 * gap0 + a1 + a2
    s2 = m0 + n0 * gap0 * gap0 + b1 + b2
    low, high = np.minimum(np.minimum(low1, low2), low0), np.maximum(np.maximum(high1, high2), high0)
    with np.errstate(invalid="ignore", divide="ignore"):
        shift = s1 / n
        deviation = np.sqrt(np.maximum(s2 - s1 * shift, 0) / (n - 1))
    flat = low == high
    return pd.DataFrame({
        "event_id": own["id"], "at": own["at"], "price": own["price"], "volume": own["volume"],
        "mean_price": np.where(flat, low, centre + shift),
        "stddev_price": np.where(n < 2, np.nan, np.where(flat, 0.0, deviation)), "count_trades": n})


def trailing_zscore_stream(
    trades: DataFrame, span_s: int, lateness: str, rule: ZScoreRule = ZScoreRule(), blocks: int = 6, salts: int = 4,
) -> DataFrame:
    """Trades (event_id, symbol, price, volume, event_time) outside their own trailing range, in append mode.

    A trade is scored when the watermark has passed the end of its block, so all trades of its
    range are in. Own trades are dealt over ``salts`` by their id; the prices of the range go to
    each of them. Trades without a symbol, a time or a price take no part, late ones are dropped.
    """
    span, block = span_s * MICROS, span_s * MICROS // blocks
    if span % blocks or block % 1000:
        raise ValueError("the span must be a whole number of blocks of whole milliseconds")
    timed = (trades.withColumn("price", number(F.col("price")))
             .filter(F.col("symbol").isNotNull() & F.col("event_time").isNotNull() & F.col("price").isNotNull())
             .withWatermark("event_time", lateness)
             .withColumn("at", F.unix_micros("event_time")))
    here = F.expr(f"(at - pmod(at, {block})) div {block}")

    def sent(role: int, ahead, to):
        return F.struct(F.lit(role).alias("role"), (here + ahead).alias("block"), to.alias("salt"))

    every = F.sequence(F.lit(0), F.lit(salts - 1))
    roles = F.concat(
        F.array(sent(OWN, F.lit(0), F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int"))),
        F.transform(every, lambda s: sent(INSIDE, F.lit(0), s)),
        F.flatten(F.transform(F.sequence(F.lit(1), F.lit(blocks - 1)), lambda k: F.transform(
            every, lambda s: sent(BETWEEN, k, s)))) if blocks > 1 else F.array().cast(
                "array<struct<role:int,block:bigint,salt:int>>"),
        F.transform(every, lambda s: sent(LEAVING, F.lit(blocks), s)))
    rows = timed.select("event_id", "symbol", "price", "volume", "event_time", "at", F.explode(roles).alias("r"))
    rows = rows.select("event_id", "symbol", "price", "volume", "event_time", "at", "r.role", "r.block", "r.salt")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            own, inside, leaving, *between = state.get
            state.remove()
            made = _trailing(np.frombuffer(own, _TRADE), np.frombuffer(inside, _TICK),
                             np.frombuffer(leaving, _TICK), tuple(between), span)
            made.insert(0, "symbol", key[0])
            yield made
            return
        own, inside, leaving, *between = state.get if state.exists else (b"", b"", b"", 0, 0.0, 0.0, np.inf, -np.inf)
        between = tuple(between)
        for some in batches:
            for role, part in some.groupby("role"):
                if role == BETWEEN:
                    between = _merge(between, _summary(part["price"].to_numpy()))
                    continue
                kind = _TRADE if role == OWN else _TICK
                ticks = np.zeros(len(part), kind)
                ticks["at"], ticks["price"] = part["at"], part["price"]
                if role == OWN:
                    ticks["volume"], ticks["id"] = part["volume"], part["event_id"]
                    own += ticks.tobytes()
                elif role == INSIDE:
                    inside += ticks.tobytes()
                else:
                    leaving += ticks.tobytes()
        state.update((own, inside, leaving, *between))
        ends = (int(key[1]) + 1) * block // 1000
        state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))

    out = ("symbol string, event_id long, at long, price double, volume double, mean_price double, "
           "stddev_price double, count_trades long")
    stats = rows.groupBy("symbol", "block", "salt").applyInPandasWithState(
        step, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    stats = stats.withColumns({"event_time": F.timestamp_micros("at"), "stddev_price": F.nanvl("stddev_price", F.lit(None)),
                               "volume": F.nanvl("volume", F.lit(None))}).drop("at")
    return outliers(scored(usable(stats, rule)), rule)
