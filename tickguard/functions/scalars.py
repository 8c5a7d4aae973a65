"""Scalar expressions of the detectors and the alert reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickguard.params import MICROS


def number(col: Column) -> Column:
    """NaN counts as missing, so it neither joins a mean nor passes a threshold."""
    return F.when(~F.isnan(col), col)


def event_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def volatility_ratio(stddev: Column, mean: Column) -> Column:
    """stddev / mean; a zero mean gives infinity."""
    return F.when(mean == 0, F.lit(float("inf"))).otherwise(F.try_divide(stddev, mean))


def z_score(price: Column, mean: Column, stddev: Column) -> Column:
    return F.try_divide(price - mean, stddev)


def is_number(col: Column) -> Column:
    return col.isNotNull() & ~F.isnan(col)


def band_edge(mean: Column, stddev: Column, sigmas: float) -> Column:
    return mean + F.lit(float(sigmas)) * stddev


def age_text(now: Column, latest: Column) -> Column:
    """Age as whole seconds below a minute, whole minutes below an hour, else whole hours."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))
    seconds = (micros / F.lit(MICROS)).cast("long")
    return (
        F.when(latest.isNull(), F.lit("—"))
        .when(seconds < 60, F.format_string("%ds", seconds))
        .when(seconds < 3600, F.format_string("%dmin", F.floor(seconds / 60)))
        .otherwise(F.format_string("%dh", F.floor(seconds / 3600)))
    )


def two_decimals(col: Column) -> Column:
    return F.when(col.isNull(), F.lit("—")).otherwise(F.format_string("%.2f", col))


def second_stamp(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd_HHmmss")


def utf8_text(payload: Column) -> Column:
    return F.decode(payload, "UTF-8")
