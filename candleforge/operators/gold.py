"""Gold: OHLCV candles and the summary per symbol.

Candles are built in two steps, partial sums per hour and their roll-up, so that hourly
and daily candles share one pass over the trades. All aggregates are hash-aggregated with
map-side partials: a symbol holding most of the rows reaches the shuffle as one row per
hour and task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge import session
from candleforge.functions import clock, measures
from candleforge.operators import silver
from candleforge.schema import AMOUNT, GOLD_DAILY, GOLD_HOURLY, NOTIONAL, VWAP
from candleforge.sources import tables

DAILY_KEY = ["symbol", "batch_date"]
HOURLY_KEY = ["symbol", "batch_date", "hour_bucket"]

PRICES = ["open_price", "high_price", "low_price", "close_price"]


def candle_partials(trades: DataFrame, exact: bool = True) -> DataFrame:
    """Aggregates over valid trades per symbol, day, hour and block of ids.

    The first and last trade follow (time, id). Within an hour and a block of 2^31 ids
    that order fits one long, which keeps every aggregate a hash aggregate over machine
    words; ids are sequential, so blocks hardly add rows. ``roll_up`` merges the blocks by
    the full order.

    In exact mode prices and quantities that fit a machine word are aggregated as such, and the
    others, if any, beside them in the same pass; a group with both gives two rows, which
    ``roll_up`` merges. Products keep all decimals. ``exact=False`` rounds each product to six
    decimals.
    """
    valid = trades.filter("is_valid")
    if not exact:
        product = measures.notional(F.col("_price"), F.col("_quantity"), exact=False)
        return _partials(valid, [_Class("", F.lit(True), AMOUNT.simpleString(), product)])
    narrow = measures.is_narrow(F.col("price"), F.col("quantity"))
    common = measures.notional(F.col("_price"), F.col("_quantity"))
    wide = measures.wide_notional(F.col("_wide_price"), F.col("_wide_quantity"))
    return _partials(
        valid,
        [
            _Class("", narrow, "decimal(18,8)", common),
            _Class("_wide", ~narrow, AMOUNT.simpleString(), wide),
        ],
    )


@dataclass(frozen=True)
class _Class:
    """Rows whose operands share a type: what they are, the type, and their product.

    Columns of a class are null in rows of the other, which no aggregate but a count sees.
    """

    prefix: str
    holds: Column
    operand: str
    product: Column

    def operands(self, position: Column) -> dict[str, Column]:
        return {
            f"{self.prefix}_is": self.holds,
            f"{self.prefix}_position": F.when(self.holds, position),
            f"{self.prefix}_price": F.when(self.holds, F.col("price")).cast(self.operand),
            f"{self.prefix}_quantity": F.when(self.holds, F.col("quantity")).cast(self.operand),
        }

    def aggregates(self) -> dict[str, Column]:
        place, price, amount = (f"{self.prefix}_{c}" for c in ("position", "price", "quantity"))
        found = {
            "first": F.min(place),
            "last": F.max(place),
            "open_price": F.min_by(price, place),
            "high_price": F.max(price),
            "low_price": F.min(price),
            "close_price": F.max_by(price, place),
            "summed": F.count(amount),
            "volume": F.try_sum(amount),
            "multiplied": F.count(self.product),
            "notional": F.try_sum(self.product),
            "trade_count": F.count_if(f"{self.prefix}_is"),
        }
        return {f"{self.prefix}_{name}": column for name, column in found.items()}

    def partial(self) -> Column:
        """The class's aggregates as a row of partials; sums are null unless they are whole."""

        def own(name: str) -> Column:
            return F.col(f"{self.prefix}_{name}")

        opened, closed = (
            (
                measures.position_time(F.col("hour_bucket"), own(end)),
                measures.position_id(F.col("_block"), own(end)),
            )
            for end in ("first", "last")
        )
        count = own("trade_count")
        amounts = {name: own(name) for name in PRICES}
        amounts["volume"] = F.when(own("summed") == count, own("volume"))
        return F.struct(
            opened[0].alias("session_open_at"),
            closed[0].alias("session_close_at"),
            measures.trade_order(*opened).alias("open_order"),
            measures.trade_order(*closed).alias("close_order"),
            *[column.try_cast(AMOUNT).alias(name) for name, column in amounts.items()],
            F.when(own("multiplied") == count, own("notional")).try_cast(NOTIONAL).alias("notional"),
            count.alias("trade_count"),
        )


def _partials(valid: DataFrame, classes: list[_Class]) -> DataFrame:
    hour = clock.hour_bucket(F.col("transact_time"))
    position = measures.position(F.col("transact_time"), hour, F.col("agg_trade_id"))
    operands = {name: c for each in classes for name, c in each.operands(position).items()}
    rows = valid.select(
        *DAILY_KEY,
        hour.alias("hour_bucket"),
        measures.id_block(F.col("agg_trade_id")).alias("_block"),
        *[column.alias(name) for name, column in operands.items()],
    )
    sums = {name: c for each in classes for name, c in each.aggregates().items()}
    grouped = rows.groupBy(*HOURLY_KEY, "_block").agg(*[c.alias(name) for name, c in sums.items()])
    if len(classes) == 1:
        return grouped.select(*HOURLY_KEY, classes[0].partial().alias("_row")).select(*HOURLY_KEY, "_row.*")
    filled = F.array_compact(F.array(*[F.when(F.col(f"{c.prefix}_trade_count") > 0, c.partial()) for c in classes]))
    return grouped.select(*HOURLY_KEY, F.inline(filled))


def roll_up(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Merge partials into coarser ones; the same numbers as from the trades themselves."""
    merged = partials.groupBy(*keys).agg(
        F.min("session_open_at").alias("session_open_at"),
        F.max("session_close_at").alias("session_close_at"),
        F.min("open_order").alias("open_order"),
        F.max("close_order").alias("close_order"),
        F.min_by("open_price", "open_order").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "close_order").alias("close_price"),
        measures.whole_sum("volume").alias("volume"),
        measures.whole_sum("notional").alias("notional"),
        F.sum("trade_count").alias("trade_count"),
    )
    return merged.withColumns(
        {
            "volume": F.col("volume").try_cast(AMOUNT),
            "notional": F.col("notional").try_cast(NOTIONAL),
        }
    )


def finished(merged: DataFrame, keys: list[str], sessions: bool) -> DataFrame:
    """Candles as published: vwap added, internal order dropped."""
    session = ["session_open_at", "session_close_at"] if sessions else []
    vwap = measures.ratio(F.col("notional"), F.col("volume")).cast(VWAP)
    return merged.select(
        *keys, *session, *PRICES, "volume", "notional", vwap.alias("vwap"), "trade_count"
    )


def hourly_candles(partials: DataFrame) -> DataFrame:
    return finished(roll_up(partials, HOURLY_KEY), HOURLY_KEY, sessions=False)


def daily_candles(partials: DataFrame) -> DataFrame:
    return finished(roll_up(partials, DAILY_KEY), DAILY_KEY, sessions=True)


def ohlcv_hourly(trades: DataFrame, exact: bool = True) -> DataFrame:
    return hourly_candles(candle_partials(trades, exact))


def ohlcv_daily(trades: DataFrame, exact: bool = True) -> DataFrame:
    return daily_candles(candle_partials(trades, exact))


def daily_from_hourly(trades: DataFrame, exact: bool = True) -> DataFrame:
    """Daily candles by way of merged hourly ones."""
    hourly = roll_up(candle_partials(trades, exact), HOURLY_KEY)
    return daily_candles(hourly)


def symbol_summary(daily: DataFrame) -> DataFrame:
    """Headline numbers per symbol over all its days."""
    day_vwap = measures.ratio(F.col("notional"), F.col("volume"))
    return (
        daily.groupBy("symbol")
        .agg(
            F.countDistinct("batch_date").alias("days_observed"),
            F.sum("volume").alias("total_volume"),
            F.sum("notional").alias("total_notional"),
            F.avg(day_vwap).alias("avg_daily_vwap"),
            F.min("session_open_at").alias("first_trade_at"),
            F.max("session_close_at").alias("last_trade_at"),
        )
        .select(
            "symbol",
            "days_observed",
            "total_volume",
            "total_notional",
            measures.ratio(F.col("total_notional"), F.col("total_volume")).alias("overall_vwap"),
            "avg_daily_vwap",
            "first_trade_at",
            "last_trade_at",
        )
    )


def layers(trades: DataFrame, exact: bool = True) -> dict[str, DataFrame]:
    """The trades as ``silver``, with the candles ``daily`` and ``hourly`` and the ``summary``.

    Partial candles are stored in the work folder, so the trades are scanned once for all
    three; they are few beside the trades.
    """
    spark = trades.sparkSession
    path = session.work_dir(spark, "partials")
    partials = candle_partials(trades, exact)
    partials.write.parquet(path)
    stored = spark.read.schema(partials.schema).parquet(path)
    daily = daily_candles(stored)
    return {
        "silver": trades,
        "daily": daily,
        "hourly": hourly_candles(stored),
        "summary": symbol_summary(daily),
    }


def with_audit(candles: DataFrame, run_id: str) -> DataFrame:
    return candles.withColumns({"_gold_at": F.current_timestamp(), "_gold_run_id": F.lit(run_id)})


def rebuild(
    trades: DataFrame, hourly_target: str, daily_target: str, run_id: str, exact: bool = True
) -> None:
    """Write both candle tables anew from all trades, with one pass over them."""
    partials = candle_partials(trades, exact).persist()
    try:
        tables.rebuild(_hourly_rows(partials, run_id), hourly_target, DAILY_KEY)
        tables.rebuild(_daily_rows(partials, run_id), daily_target, ["symbol"])
    finally:
        partials.unpersist()


def refresh(
    spark: SparkSession,
    silver_target: str,
    partitions: DataFrame,
    hourly_target: str,
    daily_target: str,
    run_id: str,
    exact: bool = True,
) -> None:
    """Rebuild only the candles of the touched (symbol, batch_date).

    A touched day without a valid trade left loses its candles, as in a full rebuild.
    """
    trades = tables.in_partitions(silver.read(spark, silver_target), partitions, DAILY_KEY)
    partials = candle_partials(trades, exact).persist()
    try:
        tables.replace_partitions(_hourly_rows(partials, run_id), hourly_target, DAILY_KEY)
        emptied = tables.without_keys(partitions, partials, DAILY_KEY)
        tables.drop_partitions(
            spark, hourly_target, tables.listed_partitions(emptied, DAILY_KEY)
        )
        daily = _daily_rows(partials, run_id)
        if not tables.exists(spark, daily_target):
            tables.replace_partitions(daily, daily_target, ["symbol"])
            return
        symbols = partitions.select("symbol").distinct()
        stored = tables.read(spark, daily_target, GOLD_DAILY)
        other_days = tables.without_keys(
            tables.in_partitions(stored, symbols, ["symbol"]), partitions, DAILY_KEY
        )
        result = other_days.unionByName(daily)
        emptied = tables.listed_partitions(
            tables.without_keys(symbols, result, ["symbol"]), ["symbol"]
        )
        tables.replace_partitions(result, daily_target, ["symbol"])
        tables.drop_partitions(spark, daily_target, emptied)
    finally:
        partials.unpersist()


def _hourly_rows(partials: DataFrame, run_id: str) -> DataFrame:
    return with_audit(hourly_candles(partials), run_id).select(*GOLD_HOURLY.names)


def _daily_rows(partials: DataFrame, run_id: str) -> DataFrame:
    return with_audit(daily_candles(partials), run_id).select(*GOLD_DAILY.names)


def register_summary_view(
    spark: SparkSession, daily_target: str, name: str = "gold_symbol_summary"
) -> DataFrame:
    """The summary as a view: computed from the daily table on every read.

    The view is kept as text, so each read lists the table's files anew.
    """
    source = f"parquet.`{daily_target}`" if tables.is_path(daily_target) else daily_target
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY VIEW {name} AS
        SELECT symbol, days_observed, total_volume, total_notional,
               CASE WHEN total_volume > 0 THEN total_notional / total_volume END AS overall_vwap,
               avg_daily_vwap, first_trade_at, last_trade_at
        FROM (
          SELECT CAST(symbol AS STRING) AS symbol,
                 count(DISTINCT batch_date) AS days_observed,
                 sum(volume) AS total_volume,
                 sum(notional) AS total_notional,
                 avg(CASE WHEN volume > 0 THEN notional / volume END) AS avg_daily_vwap,
                 min(session_open_at) AS first_trade_at,
                 max(session_close_at) AS last_trade_at
          FROM {source} GROUP BY symbol)
        """
    )
    return spark.table(name)
