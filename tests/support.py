"""Helpers of the test modules, under a name that no other folder of tests takes."""

from datetime import UTC, datetime, timedelta

START = datetime(2024, 1, 1, tzinfo=UTC)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
