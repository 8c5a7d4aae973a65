"""Keep-first and latest-revision views of alerts.

Each is an aggregate that combines before the shuffle, so a key with very many
copies reaches its task as one row per upstream task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOLATILITY_KEY = ["window_start", "window_end", "symbol", "mean_price"]
ZSCORE_KEY = ["event_time", "symbol", "price"]
WINDOW_KEY = ["window_start", "window_end", "symbol"]


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row by ``order`` of every distinct key; nulls are equal as keys.

    Keys that are not columns of ``df`` are left out. Rows equal in ``order``
    are told apart by their remaining columns, so the result is repeatable.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    first = F.min_by(F.struct(*rest), F.struct(*order, *rest)).alias("kept")
    return df.groupBy(*keys).agg(first).select(*keys, "kept.*").select(*df.columns)


def first_volatility_alerts(alerts: DataFrame, digits: int | None = None) -> DataFrame:
    """First alert per window, symbol and mean; ``digits`` rounds the mean used as key."""
    order = [c for c in ("batch_id", "count_trades", "stddev_price") if c in alerts.columns]
    if digits is None:
        return keep_first(alerts, VOLATILITY_KEY, order)
    keyed = alerts.withColumn("_mean_key", F.round("mean_price", digits))
    return keep_first(keyed, [*WINDOW_KEY, "_mean_key"], order).drop("_mean_key")


def first_zscore_alerts(alerts: DataFrame) -> DataFrame:
    order = [c for c in ("batch_id", "window_start", "volume", "mean_price") if c in alerts.columns]
    return keep_first(alerts, ZSCORE_KEY, order)


def latest_revision(alerts: DataFrame) -> DataFrame:
    """The last emitted statistics of every (window, symbol)."""
    rest = [c for c in alerts.columns if c not in WINDOW_KEY]
    last = F.max_by(F.struct(*rest), F.struct("batch_id", "count_trades", *rest)).alias("kept")
    return (alerts.groupBy(*WINDOW_KEY).agg(last)
            .select(*WINDOW_KEY, "kept.*").select(*alerts.columns))


def first_in_stream(alerts: DataFrame, lateness: str, salts: int = 8) -> DataFrame:
    """Streaming keep-first, emitted at once; state is dropped once the watermark passes.

    Copies are dealt over ``salts`` and thinned there first, so at most that many
    copies of any alert meet in one task.
    """
    dealt = (alerts.withWatermark("event_time", lateness)
             .withColumn("_salt", F.floor(F.rand(0) * salts).cast("int")))
    return (dealt.dropDuplicatesWithinWatermark([*ZSCORE_KEY, "_salt"]).drop("_salt")
            .dropDuplicatesWithinWatermark(ZSCORE_KEY))
