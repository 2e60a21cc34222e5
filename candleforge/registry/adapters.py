"""The test tables as trades, files, outcomes. Whole tables; nothing is filtered out."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleforge.operators import silver
from candleforge.schema import PARTITION, TRADE_FILE_COLUMNS
from candleforge.sources import tables, zip_source

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of one landed part file; ids are unique, so no part exceeds this.
ROWS_PER_PART = 20_000

# Stored zips are read by tasks of a few of these blocks.
STORED_BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``k`` read from props, once per row.

    As a generated column it is not copied into every filter and projection that uses it.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").withColumn("k", F.explode(F.array(k)))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed trades: symbol = type, price = value, quantity = k in props."""
    typed = _events(spark, sf_dir).select(
        F.col("event_id").alias("agg_trade_id"),
        F.col("value").cast("decimal(38,8)").alias("price"),
        F.col("k").cast("decimal(38,8)").alias("quantity"),
        F.col("event_id").alias("first_trade_id"),
        F.col("event_id").alias("last_trade_id"),
        F.col("ts").cast("timestamp").alias("transact_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        F.lit(None).cast("boolean").alias("is_best_match"),
        F.col("ts").cast("timestamp").alias("_silver_at"),
        F.upper("event_type").alias("symbol"),
        F.to_date("ts").alias("batch_date"),
    )
    return silver.with_validity(typed)


def trades_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as bronze rows with faults.

    Times are milliseconds for two symbols and microseconds for the others. The value k
    decides the fault of a row: an unreadable number, an empty or a missing cell.
    """
    events = _events(spark, sf_dir)
    symbol = F.upper("event_type")
    time = F.col("ts").cast("timestamp")
    name = F.concat(symbol, F.lit("-aggTrades-"), F.to_date("ts").cast("string"), F.lit(".zip"))
    k = F.col("k")
    return events.select(
        F.when(k == 3, "").otherwise(F.col("event_id").cast("string")).alias("agg_trade_id"),
        F.when(k == 5, "n/a")
        .when(k != 6, F.col("value").cast("decimal(38,8)").cast("string"))
        .alias("price"),
        F.when(k == 8, "-1.00000000")
        .otherwise(k.cast("decimal(38,8)").cast("string"))
        .alias("quantity"),
        F.col("event_id").cast("string").alias("first_trade_id"),
        F.when(k == 9, "x9").otherwise(F.col("event_id").cast("string")).alias("last_trade_id"),
        F.when(k == 10, "later")
        .when(F.col("event_type").isin("click", "view"), F.unix_millis(time).cast("string"))
        .otherwise(F.unix_micros(time).cast("string"))
        .alias("transact_time"),
        F.when(F.col("user_id") % 2 == 0, "TRUE").otherwise("False").alias("is_buyer_maker"),
        F.when(k > 50, "true").alias("is_best_match"),
        name.alias("_source_file_name"),
        F.when(k == 11, "short").otherwise(F.sha2(name, 256)).alias("_source_file_sha256"),
        F.lit("20240201_000000_run").alias("_pipeline_run_id"),
        F.when(k == 12, "yesterday")
        .otherwise(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        .alias("_ingested_at"),
        F.when(k == 13, F.lower(symbol)).otherwise(symbol).alias("symbol"),
        F.to_date("ts").alias("batch_date"),
    )


def landed_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as landed zip files: path, file_name, symbol, batch_date, content.

    A day is cut into parts of bounded size by id. Parts differ like real files do: with
    or without a header line, with or without the last column.
    """
    source = trades(spark, sf_dir)
    cells = F.concat_ws(
        ",",
        F.col("agg_trade_id").cast("string"),
        F.col("price").cast("string"),
        F.col("quantity").cast("string"),
        F.col("first_trade_id").cast("string"),
        F.col("last_trade_id").cast("string"),
        F.unix_micros("transact_time").cast("string"),
        F.col("is_buyer_maker").cast("string"),
    )
    is_wide = F.dayofmonth("batch_date") > 15
    line = F.when(is_wide, F.concat(cells, F.lit(",true"))).otherwise(cells)
    part = F.floor(F.col("agg_trade_id") / ROWS_PER_PART)
    parts = (
        source.select("symbol", "batch_date", part.alias("part"), line.alias("line"))
        .groupBy("symbol", "batch_date", "part")
        .agg(F.array_sort(F.collect_list("line")).alias("lines"))
    )
    header = F.when(
        F.col("symbol").isin("CLICK", "ERROR"),
        F.when(is_wide, ",".join(TRADE_FILE_COLUMNS) + "\n").otherwise(
            ",".join(TRADE_FILE_COLUMNS[:-1]) + "\n"
        ),
    ).otherwise("")
    text = F.concat(header, F.array_join("lines", "\n"), F.lit("\n"))
    name = F.concat_ws(
        "-", "symbol", F.lit("aggTrades"), F.col("batch_date").cast("string"), "part"
    )
    zipped = zipped_text
    return parts.select(
        F.concat(F.lit("landing/"), name, F.lit(".zip")).alias("path"),
        F.concat(name, F.lit(".zip")).alias("file_name"),
        "symbol",
        "batch_date",
        zipped(F.concat(name, F.lit(".csv")), text).alias("content"),
    )


def stored_zips(zips: DataFrame, target: str) -> DataFrame:
    """The zips, written once and read back, as a load reads its files several times.

    Files of a day lie together, like in a landing folder.
    """
    stored = tables.laid_out(zips, PARTITION).write.option("parquet.block.size", STORED_BLOCK_BYTES)
    stored.parquet(target)
    return zips.sparkSession.read.schema(zips.schema).parquet(target)


def landed_folder(spark: SparkSession, sf_dir: str, root: str) -> str:
    """The zips of ``landed_zips`` as files below ``root``, in folders by symbol and day."""
    write_zips(landed_zips(spark, sf_dir), root)
    return root


def write_zips(zips: DataFrame, root: str) -> None:
    """Write (symbol, batch_date, file_name, content) as files below ``root``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            store, base = zip_source.opened(root)
            for row in batch.to_pylist():
                folder = f"{base}/symbol={row['symbol']}/batch_date={row['batch_date']}"
                store.create_dir(folder, recursive=True)
                with store.open_output_stream(f"{folder}/{row['file_name']}") as out:
                    out.write(row["content"])
            yield pa.record_batch({"files": pa.array([batch.num_rows], pa.int64())})

    zips.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def zipped_text(name: Column, text: Column) -> Column:
    """A zip file with one member."""
    return F.arrow_udf(_zipped, T.BinaryType())(name, text)


def _zipped(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for names, texts in batches:
        zips = (_zip_bytes(name.as_py(), text.as_py()) for name, text in zip(names, texts))
        yield pa.array(zips, pa.binary())


def _zip_bytes(name: str, text: str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        # A fixed time keeps the bytes, and so the fingerprint, the same on every run.
        archive.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), text)
    return buffer.getvalue()


def presented(df: DataFrame) -> DataFrame:
    """Types any engine prints alike: dates as text, decimals as double, local timestamps."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            if field.dataType.scale > 12:
                column = column.cast("decimal(38,8)")
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.concat_ws(",", column)
        columns.append(column.alias(field.name))
    return df.select(*columns)
