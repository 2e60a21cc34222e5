"""User-facing reports. Each takes the table it reads and returns ordered rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.functions import clock
from candleforge.operators import gold, quality


def daily_volume_trend(daily: DataFrame) -> DataFrame:
    """Volume series per symbol, ready for a line chart."""
    columns = ["symbol", "batch_date", "volume", "notional", "vwap", "trade_count"]
    return daily.select(*columns).orderBy("symbol", "batch_date")


def symbol_overview(daily: DataFrame) -> DataFrame:
    """One row per symbol, largest traded value first."""
    return gold.symbol_summary(daily).orderBy(F.desc("total_notional"))


def intraday_price_path(
    hourly: DataFrame, daily: DataFrame, symbol: str, batch_date: dt.date | None = None
) -> DataFrame:
    """Hourly candles of one symbol on one day, by default the newest day of any symbol.

    A given day is a literal and prunes folders. The newest day is a one-row aggregate,
    so its broadcast does not grow with the data.
    """
    path = hourly.filter(F.col("symbol") == symbol)
    if batch_date is not None:
        path = path.filter(F.col("batch_date") == F.lit(batch_date))
    else:
        newest = daily.agg(F.max("batch_date").alias("batch_date"))
        path = path.join(F.broadcast(newest), "batch_date")
    columns = ["symbol", "batch_date", "hour_bucket", *gold.PRICES, "volume", "vwap", "trade_count"]
    return path.select(*columns).orderBy("hour_bucket")


def data_freshness(silver: DataFrame, now: dt.datetime) -> DataFrame:
    """Newest valid trade per symbol and how many whole hours it is behind ``now``.

    Reduced to one row per symbol and day first, so counting days adds no wide shuffle.
    """
    by_day = (
        silver.filter("is_valid")
        .groupBy("symbol", "batch_date")
        .agg(F.max("transact_time").alias("_latest"), F.max("_silver_at").alias("_loaded"))
    )
    latest = by_day.groupBy("symbol").agg(
        F.max("_latest").alias("latest_trade_at"),
        F.count("batch_date").alias("days_observed"),
        F.max("_loaded").alias("latest_silver_load_at"),
    )
    behind = clock.whole_hours_between(F.col("latest_trade_at"), F.lit(now).cast("timestamp"))
    return latest.select(
        "symbol",
        "latest_trade_at",
        "days_observed",
        behind.alias("hours_behind_now"),
        "latest_silver_load_at",
    ).orderBy("hours_behind_now")


def dq_summary(silver: DataFrame) -> DataFrame:
    """Row counts and share of invalid rows per symbol and day, newest day first."""
    return quality.validity_counts(silver).orderBy("symbol", F.desc("batch_date"))


def symbol_rollup(silver: DataFrame) -> DataFrame:
    """Plain totals per symbol over all rows, valid or not."""
    return (
        silver.groupBy("symbol")
        .agg(
            F.count("*").alias("rows"),
            F.min("transact_time").alias("first_trade"),
            F.max("transact_time").alias("last_trade"),
            F.avg("price").alias("avg_price"),
            F.sum("quantity").alias("day_volume"),
        )
        .orderBy("symbol")
    )
