"""Closed date windows, for requests and roll-ups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_windows(spark: SparkSession, start: date, end: date, max_days: int = 30) -> DataFrame:
    """(start, end): consecutive windows of max_days days, the last cut short; both ends belong to a window."""
    if end < start:
        raise ValueError(f"the end {end} is before the start {start}")
    if max_days < 1:
        raise ValueError("max_days must be 1 or more")
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return windows_between(bounds, max_days).drop("first")


def windows_between(bounds: DataFrame, max_days: int) -> DataFrame:
    """(first, start, end): the windows of each row (first, last) of bounds; none where a bound is null."""
    opening = bounds.select("first", "last", F.explode(F.expr(f"sequence(first, last, interval {int(max_days)} day)")).alias("start"))
    return opening.select("first", "start", F.least(F.date_add("start", max_days - 1), "last").alias("end"))


def request_grid(keys: DataFrame, windows: DataFrame) -> DataFrame:
    """Every key in every window: a small table by construction, one row a request series."""
    return keys.crossJoin(windows)
