import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candleforge import schema
from candleforge.operators import gold, silver
from candleforge.plans import reports
from candleforge.sources import tables

DAY = dt.date(2024, 3, 1)
COLUMNS = (
    "agg_trade_id bigint, price decimal(38,8), quantity decimal(38,8), transact_time timestamp, "
    "symbol string, batch_date date, is_valid boolean, _silver_at timestamp"
)


def trades(spark, rows):
    """Rows of (id, price, quantity, time[, symbol[, valid]])."""
    full = []
    for trade_id, price, quantity, time, *rest in rows:
        symbol = rest[0] if rest else "BTCX"
        valid = rest[1] if len(rest) > 1 else True
        full.append(
            (trade_id, Decimal(price), Decimal(quantity), time, symbol, time.date(), valid, time)
        )
    return spark.createDataFrame(full, COLUMNS)


def at(hour, minute=0, micro=0, day=1):
    return dt.datetime(2024, 3, day, hour, minute, 0, micro)


def test_ties_follow_the_id(spark):
    rows = trades(spark, [(9, "3", "1", at(1)), (5, "1", "1", at(1)), (7, "2", "1", at(1))])
    candle = gold.ohlcv_hourly(rows).first()
    assert (candle.open_price, candle.close_price) == (1, 3)


@pytest.mark.parametrize(
    "first, last",
    [(2**31 - 1, 2**31), (-1, 0), (-(2**63), 2**63 - 1), (2**40, 2**40 + 1), (-5, 2**33)],
)
def test_ties_across_id_blocks(spark, first, last):
    rows = trades(spark, [(last, "9", "1", at(1)), (first, "4", "1", at(1))])
    for candle in (gold.ohlcv_hourly(rows).first(), gold.ohlcv_daily(rows).first()):
        assert (candle.open_price, candle.close_price, candle.trade_count) == (4, 9, 2)


def test_random_trades_against_plain_python(spark):
    rng = random.Random(1)
    ids = [0, 1, 2**31 - 2, 2**31 + 1, 2**62, -7]
    rows = list(
        {
            (trade_id, time): (trade_id, f"{rng.randint(1, 10**9)}.{rng.randint(0, 10**8 - 1):08d}",
                               f"0.{rng.randint(1, 10**8 - 1):08d}", time)
            for _ in range(400)
            for trade_id in [rng.choice(ids)]
            for time in [at(rng.randint(0, 2), 0, rng.choice([0, 1, 999999]))]
        }.values()
    )
    found = {r.hour_bucket: r for r in gold.ohlcv_hourly(trades(spark, rows)).collect()}
    for hour in {row[3].replace(microsecond=0) for row in rows}:
        mine = sorted((r for r in rows if r[3].replace(microsecond=0) == hour),
                      key=lambda r: (r[3], r[0]))
        prices = [Decimal(r[1]) for r in mine]
        candle = found[hour]
        assert candle.open_price == prices[0] and candle.close_price == prices[-1]
        assert candle.high_price == max(prices) and candle.low_price == min(prices)
        assert candle.volume == sum(Decimal(r[2]) for r in mine)
        assert candle.notional == sum(Decimal(r[1]) * Decimal(r[2]) for r in mine)


def test_daily_by_way_of_hourly(spark):
    rng = random.Random(2)
    rows = trades(
        spark,
        [(i, str(rng.randint(1, 99)), str(rng.randint(1, 9)), at(rng.randint(0, 23), day=d))
         for i in range(300) for d in [rng.randint(1, 3)]],
    )
    assert sorted(gold.ohlcv_daily(rows).collect()) == sorted(
        gold.daily_from_hourly(rows).collect()
    )


def test_invalid_rows_are_left_out_and_empty_volume_has_no_vwap(spark):
    rows = trades(
        spark, [(1, "5", "1", at(1), "A", False), (2, "5", "0", at(1), "B", True)]
    )
    candles = gold.ohlcv_daily(rows).collect()
    assert [(c.symbol, c.vwap) for c in candles] == [("B", None)]


def test_large_values(spark):
    rows = trades(spark, [(1, "12345678901.5", "2", at(1))])
    assert gold.ohlcv_daily(rows).first().notional == Decimal("24691357803")
    assert gold.ohlcv_daily(rows, exact=False).first().notional == Decimal("24691357803")


def test_small_prices_keep_their_digits(spark):
    rows = trades(spark, [(1, "0.00001234", "0.00000001", at(1))])
    candle = gold.ohlcv_daily(rows).first()
    assert candle.notional == Decimal("0.0000000000001234")
    assert candle.vwap == Decimal("0.00001234")


def test_summary(spark):
    rows = trades(
        spark, [(1, "10", "1", at(1)), (2, "20", "3", at(2)), (3, "40", "4", at(5, day=2))]
    )
    summary = gold.symbol_summary(gold.ohlcv_daily(rows)).first()
    assert summary.days_observed == 2 and summary.total_volume == 8
    assert summary.overall_vwap == Decimal("28.75") and summary.avg_daily_vwap == Decimal("28.75")
    assert (summary.first_trade_at, summary.last_trade_at) == (at(1), at(5, day=2))


def test_declared_types(spark):
    rows = trades(spark, [(1, "10", "1", at(1))])
    for exact in (True, False):
        hourly = gold.with_audit(gold.ohlcv_hourly(rows, exact), "run")
        daily = gold.with_audit(gold.ohlcv_daily(rows, exact), "run")
        assert not schema.schema_differences(hourly, schema.GOLD_HOURLY)
        assert not schema.schema_differences(daily, schema.GOLD_DAILY)
        assert not schema.schema_differences(gold.symbol_summary(daily), schema.SYMBOL_SUMMARY)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_hash_aggregate_and_prune(spark):
    rows = silver.with_validity(
        spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
            F.col("event_id").alias("agg_trade_id"),
            F.col("value").cast("decimal(38,8)").alias("price"),
            F.col("user_id").cast("decimal(38,8)").alias("quantity"),
            F.col("ts").cast("timestamp").alias("transact_time"),
            F.col("event_type").alias("symbol"),
            F.to_date("ts").alias("batch_date"),
        )
    )
    for candles in (gold.ohlcv_hourly(rows), gold.ohlcv_daily(rows)):
        text = plan_of(candles)
        assert "SortAggregate" not in text and "HashAggregate" in text
        assert "props" not in text


def stored_silver(spark, rows, target):
    columns = [
        F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.SILVER
    ]
    tables.replace_partitions(rows.select(*columns), target, schema.PARTITION)


def test_refresh_equals_rebuild(spark, folder):
    target, hourly, daily = (f"{folder}/{name}" for name in ("silver", "hourly", "daily"))
    first = [(1, "10", "1", at(1)), (2, "20", "3", at(2, day=2)), (3, "7", "1", at(3), "ETHX")]
    stored_silver(spark, trades(spark, first), target)
    every = silver.read(spark, target).select(*schema.PARTITION).distinct()
    gold.refresh(spark, target, every, hourly, daily, "run1")
    # One day changes, the only day of another symbol loses its last valid trade.
    second = [(2, "25", "3", at(2, day=2)), (3, "7", "0", at(3), "ETHX", False)]
    stored_silver(spark, trades(spark, second), target)
    touched = trades(spark, second).select(*schema.PARTITION).distinct()
    gold.refresh(spark, target, touched, hourly, daily, "run2")
    gold.rebuild(silver.read(spark, target), f"{folder}/h2", f"{folder}/d2", "run3")
    audit = ("_gold_at", "_gold_run_id")
    for have, want, declared in (
        (hourly, f"{folder}/h2", schema.GOLD_HOURLY),
        (daily, f"{folder}/d2", schema.GOLD_DAILY),
    ):
        rows = [
            sorted(tables.read(spark, path, declared).drop(*audit).collect())
            for path in (have, want)
        ]
        assert rows[0] == rows[1] and rows[0]
        assert {r.symbol for r in rows[0]} == {"BTCX"}


def test_summary_view_is_fresh(spark, folder):
    stored_silver(spark, trades(spark, [(1, "10", "1", at(1))]), f"{folder}/s")
    gold.rebuild(silver.read(spark, f"{folder}/s"), f"{folder}/h", f"{folder}/d", "run")
    assert gold.register_summary_view(spark, f"{folder}/d", "fresh_view").first().days_observed == 1
    second = trades(spark, [(2, "20", "1", at(1, day=2))])
    stored_silver(spark, second, f"{folder}/s")
    touched = second.select(*schema.PARTITION).distinct()
    gold.refresh(spark, f"{folder}/s", touched, f"{folder}/h", f"{folder}/d", "run2")
    assert spark.table("fresh_view").first().days_observed == 2


def test_wide_amounts_are_exact_and_stop_nobody(spark):
    huge, tiny = "123456789012.12345678", "98765432.87654321"
    rows = trades(
        spark,
        [
            (1, huge, tiny, at(1)), (2, "2", "3", at(2)),
            (3, "1" + "0" * 20, "1" + "0" * 20, at(1), "OVER"), (4, "5", "6", at(1), "ETHX"),
        ],
    )
    found = {c.symbol: c for c in gold.ohlcv_daily(rows).collect()}
    exact = int(huge.replace(".", "")) * int(tiny.replace(".", "")) + 6 * 10**16
    assert int(f"{found['BTCX'].notional:f}".replace(".", "")) == exact
    assert found["ETHX"].notional == 30
    # What 38 digits cannot hold is unknown, not wrong.
    assert found["OVER"].notional is None and found["OVER"].trade_count == 1


def test_reports_are_ordered(spark):
    rows = trades(
        spark,
        [(1, "1", "1", at(3), "B"), (2, "9", "9", at(1), "A"), (3, "1", "1", at(2, day=2), "A")],
    )
    daily = gold.ohlcv_daily(rows)
    trend = reports.daily_volume_trend(daily).collect()
    assert [(r.symbol, r.batch_date.day) for r in trend] == [("A", 1), ("A", 2), ("B", 1)]
    assert [r.symbol for r in reports.symbol_overview(daily).collect()] == ["A", "B"]
    summary = reports.dq_summary(rows).collect()
    assert [(r.symbol, r.batch_date.day) for r in summary] == [("A", 2), ("A", 1), ("B", 1)]
    path = reports.intraday_price_path(gold.ohlcv_hourly(rows), daily, "A").collect()
    assert [r.hour_bucket for r in path] == [at(2, day=2)]
    path = reports.intraday_price_path(gold.ohlcv_hourly(rows), daily, "A", DAY).collect()
    assert [r.hour_bucket for r in path] == [at(1)]


@pytest.mark.parametrize("minute, hours", [(29, 1), (30, 2), (31, 2)])
def test_hours_behind_are_whole(spark, minute, hours):
    rows = trades(spark, [(1, "1", "1", at(0, 30))])
    fresh = reports.data_freshness(rows, at(2, minute)).first()
    assert fresh.hours_behind_now == hours and fresh.days_observed == 1
