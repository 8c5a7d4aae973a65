"""Read-side analytics over alerts: order, KPIs, filters, distributions, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickguard.functions.scalars import age_text, band_edge, is_number, two_decimals
from tickguard.operators.attach import attach
from tickguard.operators.quantiles import exact_quantiles

TABLE_COLUMNS = ["event_time", "symbol", "price", "mean_price", "stddev_price", "z_score", "volume"]
Z_SIZE = "abs(z_score)"
RATIO = "volatility_ratio"


def newest_first(alerts: DataFrame, time: str, *ties: str) -> DataFrame:
    return alerts.orderBy(F.col(time).desc_nulls_last(), *ties)


def oldest_first(alerts: DataFrame, time: str, *ties: str, per_symbol: bool = False) -> DataFrame:
    lead = ["symbol"] if per_symbol else []
    return alerts.orderBy(*lead, F.col(time).asc_nulls_last(), *ties)


def present_columns(alerts: DataFrame, wanted: list[str] = TABLE_COLUMNS) -> DataFrame:
    return alerts.select(*[c for c in wanted if c in alerts.columns])


def zscore_kpis(alerts: DataFrame) -> DataFrame:
    """Totals; an empty alert set gives zeros and a dash."""
    size = F.max(F.expr(Z_SIZE))
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.countDistinct("symbol").alias("symbols"),
        size.alias("max_abs_z"),
        two_decimals(size).alias("max_abs_z_text"))


def volatility_kpis(alerts: DataFrame, now: Column | None = None) -> DataFrame:
    latest = F.max("window_end")
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.countDistinct("symbol").alias("symbols"),
        latest.alias("latest"),
        age_text(F.current_timestamp() if now is None else now, latest).alias("age"))


def bounds(alerts: DataFrame, measure: str) -> DataFrame:
    return alerts.agg(F.min(F.expr(measure)).alias("low"), F.max(F.expr(measure)).alias("high"))


def symbols(alerts: DataFrame) -> DataFrame:
    return alerts.select("symbol").distinct().orderBy("symbol")


def selection(measure: str, chosen: list[str], low: float, high: float | None = None) -> Column:
    """Chosen symbols within an inclusive range, open above without ``high``; all else, null included, is out."""
    inside = F.col("symbol").isin(list(chosen)) & (F.expr(measure) >= low)
    if high is not None:
        inside &= F.expr(measure) <= high
    return F.coalesce(inside, F.lit(False))


def filtered(
    alerts: DataFrame, measure: str, chosen: list[str], low: float, high: float | None = None,
) -> DataFrame:
    return alerts.filter(selection(measure, chosen, low, high))


def shown_of_total(
    alerts: DataFrame, measure: str, chosen: list[str], low: float, high: float,
) -> DataFrame:
    return alerts.agg(
        F.count_if(selection(measure, chosen, low, high)).alias("shown"),
        F.count(F.lit(1)).alias("total"))


def count_by_symbol(alerts: DataFrame) -> DataFrame:
    return (alerts.filter(F.col("symbol").isNotNull())
            .groupBy("symbol").agg(F.count(F.lit(1)).alias("alerts"))
            .orderBy(F.desc("alerts"), "symbol"))


def histogram(alerts: DataFrame, value: str = "z_score", bins: int = 30) -> DataFrame:
    """Counts per symbol in ``bins`` equal bins over the whole range, the top edge included.

    Values that are all equal fall into bin 1.
    The range is a scalar subquery, not a join. The alerts are read twice, so
    settle them first when they are dear to compute.
    """
    known = alerts.filter(is_number(F.col(value)))
    ends = known.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = (F.lit(ends.select(end).scalar()) for end in ("low", "high"))
    width = (F.col("high") - F.col("low")) / bins
    slot = F.when(F.col("low") == F.col("high"), 1).otherwise(
        F.least(F.lit(bins), F.width_bucket(value, F.col("low"), F.col("high"), F.lit(bins))))
    return (
        known.withColumns({"low": low, "high": high})
        .withColumn("bin", slot.cast("long"))
        .groupBy("symbol", "bin")
        .agg(F.count(F.lit(1)).alias("alerts"),
             F.min(F.col("low") + (F.col("bin") - 1) * width).alias("bin_from"),
             F.min(F.col("low") + F.col("bin") * width).alias("bin_to"))
    )


def box_statistics(alerts: DataFrame, value: str = RATIO, **sizes) -> DataFrame:
    """Quartiles, the furthest values within 1.5 interquartile ranges, and the outliers' count.

    The alerts are read three times, so settle them first when they are dear to compute.
    """
    quartiles = exact_quantiles(
        alerts, "symbol", value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, **sizes)
    facts = (alerts.select("symbol", F.col(value).alias("x"))
             .filter(is_number(F.col("x")) & F.col("symbol").isNotNull()))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("x").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        attach(facts, quartiles, ["symbol"], "rows", **sizes)
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("alerts"),
             F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
             F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
             F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
             F.count_if(~inside).alias("outliers"))
    )


def sigma_band(alerts: DataFrame, sigmas: float = 3.0) -> DataFrame:
    mean, stddev = F.col("mean_price"), F.col("stddev_price")
    return alerts.withColumns({
        "band_low": band_edge(mean, stddev, -sigmas),
        "band_high": band_edge(mean, stddev, sigmas)})


def volatility_summary(rated: DataFrame, threshold: float, by: Column) -> DataFrame:
    """Per batch: windows analysed, alerts, and the highest ratio when nothing alerts."""
    return _summary(rated, F.col(RATIO), threshold, by)


def zscore_summary(scored: DataFrame, threshold: float, by: Column) -> DataFrame:
    return _summary(scored, F.expr(Z_SIZE), threshold, by)


def _summary(df: DataFrame, measure: Column, threshold: float, by: Column) -> DataFrame:
    alerts = F.count_if(measure > threshold)
    return df.groupBy(by.alias("batch")).agg(
        F.count(F.lit(1)).alias("analysed"), alerts.alias("alerts"),
        F.when(alerts == 0, F.max(measure)).alias("max_measure"))
