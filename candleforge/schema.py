"""Table schemas of the three layers and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT = T.DecimalType(38, 8)
NOTIONAL = T.DecimalType(38, 16)
VWAP = T.DecimalType(38, 8)

PUBLIC, INTERNAL = "PUBLIC", "INTERNAL"


def _column(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    sensitivity = INTERNAL if name.startswith("_") else PUBLIC
    return T.StructField(name, dtype, nullable, {"comment": comment, "sensitivity": sensitivity})


# Column order of a daily trade file.
TRADE_FILE_COLUMNS = [
    "agg_trade_id",
    "price",
    "quantity",
    "first_trade_id",
    "last_trade_id",
    "transact_time",
    "is_buyer_maker",
    "is_best_match",
]

PARTITION = ["symbol", "batch_date"]
TRADE_KEY = ["symbol", "batch_date", "agg_trade_id"]

BRONZE = T.StructType(
    [
        _column("agg_trade_id", T.StringType(), "trade id as text"),
        _column("price", T.StringType(), "price as text"),
        _column("quantity", T.StringType(), "base quantity as text"),
        _column("first_trade_id", T.StringType(), "first underlying trade, text"),
        _column("last_trade_id", T.StringType(), "last underlying trade, text"),
        _column("transact_time", T.StringType(), "epoch of the trade, text"),
        _column("is_buyer_maker", T.StringType(), "true when the buyer was the maker, text"),
        _column("is_best_match", T.StringType(), "best-match flag, absent in narrow files"),
        _column("_source_file_name", T.StringType(), "name of the landed file"),
        _column("_source_file_sha256", T.StringType(), "SHA-256 of the landed file"),
        _column("_pipeline_run_id", T.StringType(), "run that landed the row"),
        _column("_ingested_at", T.StringType(), "landing time, ISO text"),
        _column("symbol", T.StringType(), "trading pair, partition"),
        _column("batch_date", T.DateType(), "UTC day of the file, partition"),
    ]
)

SILVER = T.StructType(
    [
        _column("agg_trade_id", T.LongType(), "trade id, unique in (symbol, batch_date)", False),
        _column("price", AMOUNT, "trade price", False),
        _column("quantity", AMOUNT, "base quantity", False),
        _column("first_trade_id", T.LongType(), "first underlying trade", False),
        _column("last_trade_id", T.LongType(), "last underlying trade", False),
        _column("transact_time", T.TimestampType(), "trade time, UTC", False),
        _column("is_buyer_maker", T.BooleanType(), "true when the buyer was the maker", False),
        _column("is_best_match", T.BooleanType(), "best-match flag, null in narrow files"),
        _column("is_valid", T.BooleanType(), "id and time present, price and quantity > 0", False),
        _column("_source_file_name", T.StringType(), "carried from bronze", False),
        _column("_source_file_sha256", T.StringType(), "carried from bronze", False),
        _column("_pipeline_run_id", T.StringType(), "carried from bronze", False),
        _column("_ingested_at", T.TimestampType(), "carried from bronze", False),
        _column("_silver_run_id", T.StringType(), "run that typed the row", False),
        _column("_silver_at", T.TimestampType(), "time the row was typed", False),
        _column("symbol", T.StringType(), "trading pair, partition", False),
        _column("batch_date", T.DateType(), "UTC day of the file, partition", False),
    ]
)

_CANDLE = [
    _column("open_price", AMOUNT, "price of the first trade"),
    _column("high_price", AMOUNT, "highest price"),
    _column("low_price", AMOUNT, "lowest price"),
    _column("close_price", AMOUNT, "price of the last trade"),
    _column("volume", AMOUNT, "sum of quantity"),
    _column("notional", NOTIONAL, "sum of price * quantity, exact"),
    _column("vwap", VWAP, "notional / volume, null without volume"),
    _column("trade_count", T.LongType(), "number of trades"),
    _column("_gold_at", T.TimestampType(), "time the row was built"),
    _column("_gold_run_id", T.StringType(), "run that built the row"),
]

GOLD_DAILY = T.StructType(
    [
        _column("symbol", T.StringType(), "trading pair, partition"),
        _column("batch_date", T.DateType(), "UTC day"),
        _column("session_open_at", T.TimestampType(), "time of the first trade"),
        _column("session_close_at", T.TimestampType(), "time of the last trade"),
        *_CANDLE,
    ]
)

GOLD_HOURLY = T.StructType(
    [
        _column("symbol", T.StringType(), "trading pair, partition"),
        _column("batch_date", T.DateType(), "UTC day, partition"),
        _column("hour_bucket", T.TimestampType(), "start of the hour"),
        *_CANDLE,
    ]
)

SYMBOL_SUMMARY = T.StructType(
    [
        _column("symbol", T.StringType(), "trading pair"),
        _column("days_observed", T.LongType(), "number of distinct days"),
        _column("total_volume", AMOUNT, "sum of daily volume"),
        _column("total_notional", NOTIONAL, "sum of daily notional"),
        _column("overall_vwap", VWAP, "total notional / total volume"),
        _column("avg_daily_vwap", T.DecimalType(38, 12), "mean of the daily vwap"),
        _column("first_trade_at", T.TimestampType(), "earliest session open"),
        _column("last_trade_at", T.TimestampType(), "latest session close"),
    ]
)

TABLES = {
    "bronze_trades": BRONZE,
    "silver_trades": SILVER,
    "gold_ohlcv_daily": GOLD_DAILY,
    "gold_ohlcv_hourly": GOLD_HOURLY,
    "gold_symbol_summary": SYMBOL_SUMMARY,
}


class SchemaMismatch(ValueError):
    """A table does not have the columns its dictionary entry declares."""


def align(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Project onto ``schema``: fixed order, absent columns null, extras dropped or kept last.

    A present column must already have the declared type, so that evolution stays
    additive and a type drift fails when the plan is built, not in the data.
    """
    have = {f.name: f.dataType for f in df.schema}
    drifted = [
        f"{f.name}: {have[f.name].simpleString()} is not {f.dataType.simpleString()}"
        for f in schema
        if f.name in have and have[f.name] != f.dataType
    ]
    if drifted:
        raise SchemaMismatch("; ".join(drifted))
    columns = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    if keep_extra:
        declared = set(schema.names)
        columns += [F.col(name) for name in df.columns if name not in declared]
    return df.select(*columns)


def union_evolved(*tables: DataFrame) -> DataFrame:
    """Stack table versions by column name; a version without a column contributes nulls."""
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    return stacked


def schema_differences(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences in column presence and type; order and nullability are not compared."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    found = [f"missing {name}" for name in want if name not in have]
    found += [f"unexpected {name}" for name in have if name not in want]
    found += [
        f"{name} is {have[name].simpleString()}, declared {want[name].simpleString()}"
        for name in want
        if name in have and have[name] != want[name]
    ]
    return found


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` unchanged, or fail before any data is touched."""
    found = schema_differences(df, schema)
    if found:
        raise SchemaMismatch("; ".join(found))
    return df
