"""Registered queries: every operator over the test tables."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleforge import schema, session
from candleforge.operators import bronze, gold, layout, quality, runlog, silver
from candleforge.plans import daily_load, reports
from candleforge.registry import adapters
from candleforge.registry.adapters import presented, table, trades, trades_as_text
from candleforge.sources import landing, manifest, tables, zip_source
from candleforge.streaming import landing_stream, silver_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SYMBOLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]


def query(build: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(build(session.prepare(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


# Candles and reports.


@query
def ohlcv_hourly(spark, sf_dir):
    return gold.ohlcv_hourly(trades(spark, sf_dir))


@query
def ohlcv_daily(spark, sf_dir):
    return gold.ohlcv_daily(trades(spark, sf_dir))


@query
def ohlcv_daily_from_hourly(spark, sf_dir):
    return gold.daily_from_hourly(trades(spark, sf_dir))


@query
def ohlcv_daily_rounded_products(spark, sf_dir):
    return gold.ohlcv_daily(trades(spark, sf_dir), exact=False)


@query
def ohlcv_wide_amounts(spark, sf_dir):
    """Prices above 10^11 with eight decimals; notional to its last digit, as text."""
    fraction = F.col("agg_trade_id").cast("decimal(12,0)") * F.expr("0.00000001BD")
    rows = trades(spark, sf_dir).withColumns(
        {
            name: (F.col(name).cast("decimal(20,8)") + more + fraction).cast("decimal(38,8)")
            for name, more in (("price", F.lit(100_000_000_000)), ("quantity", F.lit(0)))
        }
    )
    return gold.ohlcv_daily(rows).select(
        "symbol", "batch_date", F.col("notional").cast("string").alias("notional"), "trade_count"
    )


@query
def symbol_summary(spark, sf_dir):
    return gold.symbol_summary(gold.ohlcv_daily(trades(spark, sf_dir)))


@query
def daily_volume_trend(spark, sf_dir):
    return reports.daily_volume_trend(gold.ohlcv_daily(trades(spark, sf_dir)))


@query
def symbol_overview(spark, sf_dir):
    return reports.symbol_overview(gold.ohlcv_daily(trades(spark, sf_dir)))


@query
def intraday_price_path(spark, sf_dir):
    rows = trades(spark, sf_dir)
    return reports.intraday_price_path(gold.ohlcv_hourly(rows), gold.ohlcv_daily(rows), "CLICK")


@query
def intraday_price_path_on_day(spark, sf_dir):
    rows = trades(spark, sf_dir)
    return reports.intraday_price_path(
        gold.ohlcv_hourly(rows), gold.ohlcv_daily(rows), "VIEW", dt.date(2024, 1, 15)
    )


@query
def data_freshness(spark, sf_dir):
    return reports.data_freshness(trades(spark, sf_dir), dt.datetime(2024, 2, 1))


@query
def dq_summary(spark, sf_dir):
    return reports.dq_summary(trades(spark, sf_dir))


@query
def symbol_rollup(spark, sf_dir):
    rolled = reports.symbol_rollup(trades(spark, sf_dir))
    return rolled.withColumn("avg_price", F.col("avg_price").cast("decimal(38,10)"))


# Bronze to silver.

_SILVER_SHOWN = [
    "symbol", "batch_date", "agg_trade_id", "price", "quantity", "first_trade_id",
    "last_trade_id", "transact_time", "is_buyer_maker", "is_best_match", "is_valid",
    "_ingested_at",
]


@query
def silver_typed(spark, sf_dir):
    typed = silver.with_validity(silver.typed(trades_as_text(spark, sf_dir)))
    return typed.select(*_SILVER_SHOWN)


@query
def silver_from_bronze(spark, sf_dir):
    typed = silver.from_bronze(trades_as_text(spark, sf_dir), "20240201_000000_run")
    return typed.select(*_SILVER_SHOWN)


@query
def silver_dedup(spark, sf_dir):
    return silver.dedup_latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


def _orders_versions(spark, sf_dir):
    """A stored state of ``orders`` and a batch that changes some rows and adds others."""
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    is_new = F.col("o_orderpriority") == "1-URGENT"
    stored = orders.filter(~is_new)
    batch = orders.filter(is_new | (F.col("o_orderstatus") == "P")).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    return stored, batch


@query
def silver_upsert(spark, sf_dir):
    stored, batch = _orders_versions(spark, sf_dir)
    target = session.work_dir(spark, "upsert")
    key = ["order_year", "o_orderkey"]
    for rows in (stored, batch, batch):
        tables.upsert(spark, target, rows, key, ["order_year"])
    return tables.read(spark, target, T.StructType(stored.schema.fields))


@query
def upsert_match(spark, sf_dir):
    stored, batch = _orders_versions(spark, sf_dir)
    return tables.merged(stored, batch, ["o_orderkey"])


# Quality.


@query
def dq_not_null(spark, sf_dir):
    bad = quality.not_null(silver.typed(trades_as_text(spark, sf_dir)), "agg_trade_id")
    return bad.select("first_trade_id", "symbol", "batch_date")


@query
def dq_accepted_values(spark, sf_dir):
    bad = quality.accepted_values(trades(spark, sf_dir), "symbol", SYMBOLS[:3])
    return bad.select("agg_trade_id", "symbol")


@query
def dq_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "orders"), "o_custkey")


@query
def dq_unique_combination(spark, sf_dir):
    return quality.unique_combination(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def dq_suite(spark, sf_dir):
    rows = silver.with_validity(silver.typed(trades_as_text(spark, sf_dir)))
    return quality.run_suite(gold.layers(rows), quality.trade_suite(SYMBOLS))


@query
def contract_violations_bronze(spark, sf_dir):
    bad = quality.bronze_violations(trades_as_text(spark, sf_dir))
    return bad.select("first_trade_id", "violations")


@query
def contract_violations_silver(spark, sf_dir):
    typed = silver.with_validity(silver.typed(trades_as_text(spark, sf_dir)))
    stamped = silver.with_audit(typed, "20240201_000000_run")
    return quality.silver_violations(stamped).select("first_trade_id", "violations")


@query
def rejection_gate(spark, sf_dir):
    return quality.rejection_gate(trades(spark, sf_dir), limit_pct=1.0)


@query
def row_floor_gate(spark, sf_dir):
    landed = trades_as_text(spark, sf_dir)
    kept = silver.with_validity(silver.typed(landed)).filter("is_valid")
    return quality.row_floor_gate(landed, kept, floor_pct=96.0)


@query
def temporal_violations(spark, sf_dir):
    batch_day = F.when(F.col("quantity") == 0, F.date_sub("batch_date", 1)).otherwise(
        F.col("batch_date")
    )
    rows = trades(spark, sf_dir).withColumn("batch_date", batch_day)
    bad = quality.temporal_violations(rows, earliest=dt.date(2024, 1, 5))
    return bad.select("agg_trade_id", "symbol", "batch_date", "transact_time", "reason")


@query
def quarantine(spark, sf_dir):
    bad = quality.quarantine(trades_as_text(spark, sf_dir))
    return bad.select("first_trade_id", "violations", "malformed")


# Landing and manifest.


@query
def fingerprint(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", landing.fingerprint(F.col("text")).alias("sha256"))


def _document_versions(spark, sf_dir):
    """Documents as scanned files, and a manifest of an earlier state of them.

    Then, one source did not exist yet and the texts of one language were in upper case.
    """
    docs = table(spark, sf_dir, "documents")
    scanned = docs.select("doc_id", landing.fingerprint(F.col("text")).alias("sha256"))
    earlier = F.when(F.col("lang") == "fr", F.upper("text")).otherwise(F.col("text"))
    known = docs.filter(F.col("source") != "src3").select(
        "doc_id", landing.fingerprint(earlier).alias("sha256")
    )
    return scanned, known


@query
def change_detection(spark, sf_dir):
    return manifest.detect_changes(*_document_versions(spark, sf_dir), keys=["doc_id"])


@query
def skip_unchanged(spark, sf_dir):
    return manifest.skip_unchanged(*_document_versions(spark, sf_dir), keys=["doc_id"])


@query
def missing_sources(spark, sf_dir):
    present = trades(spark, sf_dir).select(
        "symbol", F.date_trunc("HOUR", "transact_time").alias("slot")
    )
    ends = present.agg(F.min("slot"), F.max("slot")).first()
    first, last = (F.lit(end).cast("timestamp") for end in ends)
    expected = manifest.expected_slots(present, first, last, "1 hour", "slot")
    return manifest.missing_sources(expected, present, ["symbol", "slot"])


@query
def file_keys(spark, sf_dir):
    named = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit("raw/"),
            F.when(F.col("o_orderpriority") == "5-LOW", "x y").otherwise(
                F.concat(F.lit("ST"), "o_orderstatus")
            ),
            F.lit("-aggTrades-"),
            F.to_date("o_orderdate").cast("string"),
            F.lit(".zip"),
        ).alias("path"),
    )
    return landing.with_file_keys(named).drop("path")


@query
def zip_scan(spark, sf_dir):
    parsed = landing.parse_zipped_csv(adapters.landed_zips(spark, sf_dir))
    return landing.readable(parsed).drop("path")


@query
def zip_source_scan(spark, sf_dir):
    """The zips as files on storage, read by the data source."""
    root = adapters.landed_folder(spark, sf_dir, session.work_dir(spark, "landed-zips"))
    rows = landing.readable(zip_source.read(spark, root, bin_bytes=1 << 20))
    return rows.drop("path", "length", "sha256")


@query
def bronze_round_trip(spark, sf_dir):
    target = session.work_dir(spark, "bronze")
    rows = trades_as_text(spark, sf_dir)
    bronze.write(rows, target)
    bronze.write(rows, target)  # landing again replaces, it does not double
    return bronze.read(spark, target)


@query
def bronze_one_batch(spark, sf_dir):
    target = session.work_dir(spark, "bronze")
    bronze.write(trades_as_text(spark, sf_dir), target)
    return bronze.read(spark, target, "2024-01-07").select(
        "symbol", "batch_date", "first_trade_id", "price"
    )


@query
def schema_align(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    is_old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    older = orders.filter(is_old).drop("o_orderpriority")
    newer = orders.filter(~is_old).withColumn("o_channel", F.lit("web"))
    declared = T.StructType(
        [f for f in orders.schema] + [T.StructField("o_channel", T.StringType())]
    )
    return schema.align(schema.union_evolved(older, newer), declared)


# Runs and upkeep.


@query
def run_status(spark, sf_dir):
    outcome = (
        F.when(F.col("event_type") == "click", runlog.PROCESSED)
        .when(F.col("event_type") == "view", runlog.SKIPPED_UNCHANGED)
        .when(F.col("event_type") == "error", runlog.ERROR)
        .otherwise(runlog.MISSING_SOURCE)
    )
    outcomes = table(spark, sf_dir, "events").select(
        F.concat_ws("_", F.date_format("ts", "yyyyMMdd"), "user_id").alias("run_id"),
        outcome.alias("outcome"),
    )
    return runlog.run_status(outcomes)


@query
def run_retention(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stamp = (
        F.when(F.col("o_orderpriority") == "5-LOW", "manual")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "19981399")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    log = orders.select(F.concat_ws("_", stamp, F.lit("000000"), "o_orderkey").alias("run_id"))
    return runlog.retention(log, dt.date(1998, 8, 1))


@query
def tier_report(spark, sf_dir):
    folder = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "bad-records/")
        .when(F.col("o_orderpriority") == "2-HIGH", "archive/")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "bronze/delta/")
        .when(F.col("o_orderpriority") == "5-LOW", "silver/")
        .otherwise("bronze/raw/")
    )
    objects = table(spark, sf_dir, "orders").select(
        F.concat(folder, F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_orderdate").alias("modified"),
    )
    return layout.tier_report(objects, dt.date(2001, 8, 2), modified="modified")


def _stored_lineitem(spark, sf_dir, label):
    target = session.work_dir(spark, label)
    rows = table(spark, sf_dir, "lineitem")
    partition_by = ["l_returnflag", "l_linestatus"]
    # Few partitions: each gets a writer in every task, instead of a sort of the task's rows.
    with session.session_conf(spark, spark__sql__maxConcurrentOutputFileWriters=tables.OPEN_WRITERS):
        rows.write.partitionBy(*partition_by).parquet(target)
    return target, partition_by, rows.schema


@query
def compact(spark, sf_dir):
    target, partition_by, stored = _stored_lineitem(spark, sf_dir, "compact")
    layout.compact(spark, target, partition_by)
    return tables.read(spark, target, stored)


@query
def cluster_by(spark, sf_dir):
    target, partition_by, stored = _stored_lineitem(spark, sf_dir, "cluster")
    layout.cluster_by(spark, target, partition_by, ["l_shipdate", "l_orderkey"])
    return tables.read(spark, target, stored)


@query
def compaction_choice(spark, sf_dir):
    """Orders as files of a partition, their totals as sizes: which go together into one."""
    files = table(spark, sf_dir, "orders").select(
        F.concat_ws("-", "o_orderpriority", F.year("o_orderdate")).alias("partition"),
        F.col("o_orderkey").cast("string").alias("file"),
        F.round("o_totalprice").cast("long").alias("bytes"),
    )
    chosen = layout.crowded(files, COMPACTED_BYTES)
    return layout.packed(files, COMPACTED_BYTES).join(chosen.drop("bytes"), "partition")


COMPACTED_BYTES = 400_000


@query
def compact_twice(spark, sf_dir):
    """Partitions rewritten by a first and by a second call, and the rows afterwards."""
    target = session.work_dir(spark, "compact-twice")
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    # One year is well laid, the others come in several files.
    spread = F.when(F.col("o_year") == 1995, 0).otherwise(F.col("o_orderkey") % 8)
    parts = orders.repartitionById(8, spread.cast("int"))
    parts.write.partitionBy("o_year").parquet(target)
    calls = [layout.compact(spark, target, ["o_year"]) for _ in range(2)]
    files = layout.file_sizes(spark, target, ["o_year"]).count()
    return tables.read(spark, target).agg(
        F.lit(calls[0]).alias("first"), F.lit(calls[1]).alias("second"),
        F.lit(files).alias("files"), F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"),
    )


@query
def curve_key(spark, sf_dir):
    """Each line's place on the curve through ship date and order."""
    rows = table(spark, sf_dir, "lineitem")
    # So accurate that the bounds are the exact quantiles.
    columns = ["l_shipdate", "l_orderkey"]
    placed = layout.with_curve(rows, columns, bits=5, name="place", accuracy=100_000_000)
    return placed.select("l_orderkey", "l_linenumber", "place")


@query
def cluster_by_curve(spark, sf_dir):
    """Whether files of a table along the curve are narrow in both columns."""
    target, partition_by, stored = _stored_lineitem(spark, sf_dir, "curve")
    columns = ["l_shipdate", "l_orderkey"]
    layout.cluster_by(spark, target, partition_by, columns, curve=True, ranges=256)
    spread = layout.column_spread(tables.read(spark, target, stored), columns)
    return spread.groupBy("column").agg(
        F.sum("rows").alias("n"),
        (F.sum(F.col("share") * F.col("rows")) < 0.5 * F.sum("rows")).alias("narrow"),
    )


# Whole loads.


FIRST_RUN = "20240201_000000_first"


def _loaded_lake(spark, sf_dir, label, gates=None, spoiled=None):
    lake = daily_load.Lake(session.work_dir(spark, label))
    zips = adapters.landed_zips(spark, sf_dir)
    if spoiled is not None:
        content = F.when(F.col("file_name") == spoiled, F.lit(b"no zip")).otherwise(F.col("content"))
        zips = zips.withColumn("content", content)
    zips = adapters.stored_zips(zips, session.work_dir(spark, f"{label}-landed"))
    expected = trades(spark, sf_dir).select(*schema.PARTITION).distinct()

    def files(partitions):
        if partitions is None:
            return zips
        return tables.in_partitions(zips, partitions, schema.PARTITION)

    daily_load.load(spark, files, lake, FIRST_RUN, expected, gates=gates)
    return lake


@query
def daily_load_to_gold(spark, sf_dir):
    lake = _loaded_lake(spark, sf_dir, "load")
    return tables.read(spark, lake.daily, schema.GOLD_DAILY).drop("_gold_at", "_gold_run_id")


@query
def backfill_hourly(spark, sf_dir):
    lake = _loaded_lake(spark, sf_dir, "backfill")
    days = [row[0] for row in trades(spark, sf_dir).select("batch_date").distinct().collect()]
    daily_load.backfill(spark, lake, "20240202_000000_again", days, gates=None)
    return tables.read(spark, lake.hourly, schema.GOLD_HOURLY).drop("_gold_at", "_gold_run_id")


@query
def run_log_of_load(spark, sf_dir):
    """What a load with one unreadable file writes into the run log."""
    first = adapters.landed_zips(spark, sf_dir).agg(F.min("file_name")).first()[0]
    lake = _loaded_lake(spark, sf_dir, "logged", quality.Gates(rejection_limit_pct=100), first)
    log = runlog.read(spark, lake.run_log)
    timed = (F.col("started_at") <= F.col("ended_at")).alias("timed")
    return log.select("run_id", "stage", "status", "rows_in", "rows_out", "duplicates_dropped", timed)


@query
def audit_columns(spark, sf_dir):
    """Run ids, file hashes and times by day, followed from the landed files to the candles."""
    lake = _loaded_lake(spark, sf_dir, "audited")
    landed = landing.with_fingerprint(adapters.landed_zips(spark, sf_dir))
    hashes = landed.groupBy(*schema.PARTITION).agg(F.array_sort(F.collect_set("sha256")).alias("landed"))
    typed = silver.read(spark, lake.silver).groupBy(*schema.PARTITION).agg(
        F.array_sort(F.collect_set("_source_file_sha256")).alias("carried"),
        F.count_distinct("_source_file_name").alias("files"),
        F.min("_pipeline_run_id").alias("bronze_run"),
        F.max("_silver_run_id").alias("silver_run"),
        F.count_if(F.col("_ingested_at") > F.col("_silver_at")).alias("untimely"),
        F.max("_silver_at").alias("_silver_at"),
    )
    hourly = tables.read(spark, lake.hourly, schema.GOLD_HOURLY).groupBy(*schema.PARTITION).agg(
        F.max("_gold_run_id").alias("gold_run"), F.min("_gold_at").alias("_gold_at")
    )
    days = typed.join(hashes, schema.PARTITION).join(hourly, schema.PARTITION, "left")
    return days.select(
        *schema.PARTITION, "files", "bronze_run", "silver_run", "gold_run", "untimely",
        (F.col("landed") == F.col("carried")).alias("hashes_carried"),
        (F.col("_silver_at") <= F.col("_gold_at")).alias("gold_after_silver"),
    )


@query
def summary_view(spark, sf_dir):
    """The summary view over a catalog table, read again after one more day was landed."""
    daily = gold.daily_candles(gold.candle_partials(trades(spark, sf_dir)))
    daily = gold.with_audit(daily, FIRST_RUN).select(*schema.GOLD_DAILY.names)
    last = daily.agg(F.max("batch_date")).first()[0]
    name = "candleforge_daily_of_view"
    before = daily.filter(F.col("batch_date") < F.lit(last))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    before.write.format("parquet").option("path", session.work_dir(spark, "view")).partitionBy(
        "symbol"
    ).saveAsTable(name)
    view = gold.register_summary_view(spark, name, "candleforge_summary_view")
    view.count()
    tables.replace_partitions(daily, name, ["symbol"])
    return spark.table("candleforge_summary_view")


@query
def gated_load(spark, sf_dir):
    """A load whose gates stop some days: outcome, reasons, and the trades published, by day."""
    gates = quality.Gates(rejection_limit_pct=1.0)
    lake = _loaded_lake(spark, sf_dir, "gated", gates)
    outcomes = spark.read.schema("symbol string, batch_date date, outcome string").parquet(lake.outcomes)
    verdicts = spark.read.schema("symbol string, batch_date date, reasons array<string>").parquet(lake.gates)
    daily = tables.read(spark, lake.daily, schema.GOLD_DAILY)
    published = daily.select(*schema.PARTITION, "trade_count")
    rows = silver.read(spark, lake.silver).groupBy(*schema.PARTITION).agg(F.count("*").alias("silver_rows"))
    verdicts = verdicts.drop("run_id")
    days = outcomes.drop("run_id").join(verdicts, schema.PARTITION).join(rows, schema.PARTITION, "left")
    return days.join(published, schema.PARTITION, "left")


@query
def backfill_resumed(spark, sf_dir):
    """A backfill stopped after its first group and called again: partitions by group, and candles."""
    lake = _loaded_lake(spark, sf_dir, "resumed")
    for most in (1, None):
        daily_load.backfill(
            spark, lake, "20240202_000000_again", gates=None, group_size=60, most_groups=most
        )
    done = daily_load.backfilled(spark, lake, "20240202_000000_again")
    hourly = tables.read(spark, lake.hourly, schema.GOLD_HOURLY)
    rebuilt = hourly.filter("_gold_run_id = '20240202_000000_again'").groupBy(*schema.PARTITION).agg(
        F.count("*").alias("hours"), F.sum("volume").alias("volume"), F.sum("trade_count").alias("trades")
    )
    return done.select(*schema.PARTITION, "group").join(rebuilt, schema.PARTITION, "left")


@query
def stream_from_landing(spark, sf_dir):
    """Files as they arrive: once all, then all again, of which only those of one symbol differ.

    ``loaded`` is the run of the candles: the second batch for the symbol that came again.
    """
    root = session.work_dir(spark, "arriving")
    lake = daily_load.Lake(f"{root}/lake")
    zips = adapters.landed_zips(spark, sf_dir)
    cut_short = F.col("symbol") == "CLICK"
    empty = adapters.zipped_text(F.lit("empty.csv"), F.lit(""))
    first = zips.withColumn("content", F.when(cut_short, empty).otherwise(F.col("content")))
    for arrival, files in (("first", first), ("second", zips)):
        adapters.write_zips(files, f"{root}/landing/received={arrival}")
        landing_stream.stream_load(
            spark, f"{root}/landing", lake, f"{root}/checkpoint", "arrival", files_per_batch=100_000
        ).awaitTermination()
    daily = tables.read(spark, lake.daily, schema.GOLD_DAILY)
    return daily.withColumnRenamed("_gold_run_id", "loaded").drop("_gold_at")


@query
def stream_upsert(spark, sf_dir):
    root = session.work_dir(spark, "stream")
    bronze.write(trades_as_text(spark, sf_dir), f"{root}/bronze")
    silver_stream.stream_upsert(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint", "stream"
    ).awaitTermination()
    return silver.read(spark, f"{root}/silver").select(*_SILVER_SHOWN)
