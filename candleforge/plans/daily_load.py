"""The daily load: landed files to bronze, silver and gold, set-based over all symbols."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.functions import clock
from candleforge.operators import bronze, gold, quality, runlog, silver
from candleforge.schema import PARTITION
from candleforge.sources import landing, manifest, storage, tables

CHANGE_TO_LOAD = [manifest.NEW, manifest.CHANGED]


@dataclass(frozen=True)
class Lake:
    """Where the tables live: all below one shared root."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self._at("bronze/trades")

    @property
    def silver(self) -> str:
        return self._at("silver/trades")

    @property
    def hourly(self) -> str:
        return self._at("gold/ohlcv_hourly")

    @property
    def daily(self) -> str:
        return self._at("gold/ohlcv_daily")

    @property
    def manifest(self) -> str:
        return self._at("state/manifest")

    @property
    def scans(self) -> str:
        return self._at("state/scans")

    @property
    def checks(self) -> str:
        return self._at("state/checks")

    @property
    def outcomes(self) -> str:
        return self._at("state/outcomes")

    @property
    def gates(self) -> str:
        return self._at("state/gates")

    @property
    def backfills(self) -> str:
        return self._at("state/backfills")

    def staged_silver(self, run_id: str) -> str:
        return self._at(f"staging/silver/{tables.folder_text(run_id)}")

    @property
    def run_log(self) -> str:
        return self._at("state/run_log")

    @property
    def bad_files(self) -> str:
        return self._at("bad-records/files")

    @property
    def bad_rows(self) -> str:
        return self._at("bad-records/rows")


def run(
    spark: SparkSession,
    landing_root: str,
    lake: Lake,
    run_id: str,
    symbols: list[str],
    batch_dates: list[dt.date] | None = None,
    today: dt.date | None = None,
    epoch_unit: str = "auto",
    exact: bool = True,
    gates: quality.Gates | None = None,
) -> dict:
    """Load the landed files of ``batch_dates`` (default: the day before ``today``).

    Returns the status row of the run. An unreadable or missing file, or a day that a gate
    stops, does not stop the others.
    """
    if batch_dates is None:
        batch_dates = [clock.previous_day(today or dt.datetime.now(dt.timezone.utc).date())]
    wanted = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    expected = wanted.withColumn(
        "batch_date", F.explode(F.array(*[F.lit(day) for day in batch_dates]))
    )

    def files(partitions: DataFrame | None) -> DataFrame:
        return landing.landed_files(spark, landing_root, batch_dates, partitions)

    return load(spark, files, lake, run_id, expected, epoch_unit, exact, gates)


def load(
    spark: SparkSession,
    files,
    lake: Lake,
    run_id: str,
    expected: DataFrame,
    epoch_unit: str = "auto",
    exact: bool = True,
    gates: quality.Gates | None = None,
) -> dict:
    """Load what changed among ``files``.

    ``files(partitions)`` gives the landed files (path, file_name, symbol, batch_date,
    content), of all partitions for None. ``expected`` lists the (symbol, batch_date) the
    run is about. The unit of loading is the partition: if one of its files changed, all
    its files are parsed, since bronze replaces whole partitions. While one of them is
    unreadable, a partition that bronze holds stays as it was; one whose files have no rows
    any more is emptied, through gold.

    Silver is written aside, audited by ``gates`` and then published, day by day: a
    (symbol, batch_date) that a gate stops keeps the state it had in silver and gold, its
    reasons are kept, and its outcome is an error. Without gates all is published.
    """
    started = dt.datetime.now(dt.timezone.utc)
    scans = _record_scan(spark, files, lake, run_id, expected)
    to_load = scans.filter(F.col("change").isin(CHANGE_TO_LOAD)).select(*PARTITION).distinct()
    entries = []
    try:
        if not to_load.isEmpty():
            checks = _check_files(files(to_load), lake, run_id)
            entries.append(_load_bronze(files(to_load), checks, lake, run_id, started))
            emptied = _clear_emptied(checks, lake)
            if tables.exists(spark, lake.bronze):
                entries += refresh_from_bronze(
                    spark, lake, to_load, run_id, epoch_unit, exact, gates
                )
            elif emptied and tables.exists(spark, lake.hourly):
                gold.refresh(spark, lake.silver, to_load, lake.hourly, lake.daily, run_id, exact)
            _record_files(spark, scans, lake, run_id)
    except Exception:
        # The run log tells of a failed run; its files count as not loaded.
        entries.append(_entry("run", "FAILED", started, run_id))
        runlog.append(spark, lake.run_log, entries)
        raise
    status = _record_outcomes(spark, scans, expected, lake, run_id)
    entries.append(_entry("run", status["status"], started, run_id))
    runlog.append(spark, lake.run_log, entries)
    return status


def _entry(stage: str, status: str, started: dt.datetime, run_id: str) -> dict:
    ended = dt.datetime.now(dt.timezone.utc)
    return {
        "stage": stage, "status": status, "started_at": started, "ended_at": ended,
        "run_id": run_id,
    }


def _record_scan(spark, files, lake: Lake, run_id: str, expected: DataFrame) -> DataFrame:
    """Fingerprint the files and store how each compares with the manifest.

    One narrow row per file, written once: every later step reads it back, so files are
    hashed once even when tasks are repeated.
    """
    hashed = landing.with_fingerprint(files(None)).select("path", *manifest.FILE_KEY, "sha256")
    hashed = tables.in_partitions(hashed, expected, PARTITION)
    known = manifest.read_manifest(spark, lake.manifest)
    changes = manifest.detect_changes(hashed, known).withColumn("run_id", F.lit(run_id))
    tables.replace_partitions(changes, lake.scans, ["run_id"])
    if not tables.exists(spark, lake.scans):
        return tables.empty(spark, changes.schema)
    scans = spark.read.schema(changes.schema).parquet(lake.scans)
    return scans.filter(F.col("run_id") == run_id)


def _check_files(files: DataFrame, lake: Lake, run_id: str) -> DataFrame:
    """Decode the files once to tell bad, empty and overlong ones; one stored row per file."""
    checks = landing.check_zipped_csv(landing.with_fingerprint(files))
    checks = checks.withColumn("run_id", F.lit(run_id))
    tables.replace_partitions(checks, lake.checks, ["run_id"])
    stored = files.sparkSession.read.schema(checks.schema).parquet(lake.checks)
    return stored.filter(F.col("run_id") == run_id)


def _load_bronze(
    files: DataFrame, checks: DataFrame, lake: Lake, run_id: str, started: dt.datetime
) -> dict:
    spark = files.sparkSession
    bad = checks.filter(F.col(landing.PARSE_ERROR).isNotNull())
    flags = {"unreadable files": F.col(landing.PARSE_ERROR).isNotNull(), "files with surplus cells": F.col(landing.EXTRA_CELLS)}
    found = checks.agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()]).first().asDict()
    bad_files = found["unreadable files"]
    if bad_files:
        quality.write_quarantine(
            bad.drop("run_id", landing.EXTRA_CELLS, landing.FILE_ROWS), lake.bad_files, run_id
        )
        with_bad = tables.partition_filter(bad, PARTITION)
        good = files.filter(with_bad).join(bad.select("path"), "path", "left_anti")
        if tables.exists(spark, lake.bronze):
            held = bronze.read(spark, lake.bronze).filter(with_bad)
            held = tables.partition_filter(held, PARTITION)
            good = good if held is tables.NO_PARTITION else good.filter(~held)
        files = files.filter(~with_bad).unionByName(good)
    metrics = runlog.WriteMetrics(rows_in=F.count("*"))
    rows = landing.parse_zipped_csv(landing.with_fingerprint(files), checked=True)
    rows = metrics.attach(landing.readable(rows))
    bronze.write(bronze.with_audit(rows, run_id, started), lake.bronze, from_files=True)
    rows_in = metrics.values()["rows_in"]
    return {
        "stage": "bronze",
        "status": "PARTIAL" if bad_files else "SUCCESS",
        "rows_in": rows_in + bad_files,
        "rows_out": rows_in,
        "started_at": started,
        "ended_at": dt.datetime.now(dt.timezone.utc),
        "reason": ", ".join(f"{name}: {n}" for name, n in found.items() if n) or None,
        "run_id": run_id,
    }


def _clear_emptied(checks: DataFrame, lake: Lake) -> bool:
    """Remove the stored rows of days whose files are all readable and have no row."""
    emptied = (
        checks.groupBy(*PARTITION)
        .agg(F.sum(landing.FILE_ROWS).alias("rows"), F.count(landing.PARSE_ERROR).alias("bad"))
        .filter("rows = 0 AND bad = 0")
    )
    # As many as there are partitions to load, which the load lists as literals anyway.
    listed = tables.listed_partitions(emptied, PARTITION)
    for target in (lake.bronze, lake.silver):
        tables.drop_partitions(checks.sparkSession, target, listed)
    return bool(listed)


def refresh_from_bronze(
    spark: SparkSession,
    lake: Lake,
    partitions: DataFrame,
    run_id: str,
    epoch_unit: str = "auto",
    exact: bool = True,
    gates: quality.Gates | None = None,
) -> list[dict]:
    """Upsert the listed partitions into silver and rebuild the candles of those published."""
    started = dt.datetime.now(dt.timezone.utc)
    rows = tables.in_partitions(bronze.read(spark, lake.bronze), partitions, PARTITION)
    rows_in = rows.count()  # answered from parquet footers
    staged = None if gates is None else lake.staged_silver(run_id)
    metrics = runlog.WriteMetrics(rows_out=F.count_if(F.col("_silver_run_id") == run_id))
    silver.upsert(
        spark, lake.silver, rows, run_id, epoch_unit, partitions, observe=metrics.attach, into=staged
    )
    rows_out = metrics.values()["rows_out"]
    typed_at = dt.datetime.now(dt.timezone.utc)
    entries = [
        {
            "stage": "silver",
            "status": "SUCCESS",
            "rows_in": rows_in,
            "rows_out": rows_out,
            "duplicates_dropped": rows_in - rows_out,
            "started_at": started,
            "ended_at": typed_at,
            "run_id": run_id,
        }
    ]
    quality.write_quarantine(quality.quarantine(rows), lake.bad_rows, run_id)
    if gates is not None:
        verdicts = _audited(spark, rows, lake, run_id, gates)
        entries.append(_publish(spark, verdicts, lake, run_id, typed_at))
        partitions = verdicts.filter("passed").select(*PARTITION)
    audited_at = dt.datetime.now(dt.timezone.utc)
    if gates is None or not partitions.isEmpty():
        gold.refresh(spark, lake.silver, partitions, lake.hourly, lake.daily, run_id, exact)
    entries.append(
        {
            "stage": "gold",
            "status": "SUCCESS",
            "started_at": audited_at,
            "ended_at": dt.datetime.now(dt.timezone.utc),
            "run_id": run_id,
        }
    )
    return entries


def _audited(
    spark: SparkSession, landed: DataFrame, lake: Lake, run_id: str, gates: quality.Gates
) -> DataFrame:
    """The verdict of the gates on each staged partition, stored."""
    staged = silver.read(spark, lake.staged_silver(run_id))
    verdicts = quality.audit(landed, staged, gates).withColumn("run_id", F.lit(run_id))
    tables.replace_partitions(verdicts, lake.gates, ["run_id"])
    stored = spark.read.schema(verdicts.schema).parquet(lake.gates)
    return stored.filter(F.col("run_id") == run_id)


def _publish(
    spark: SparkSession, verdicts: DataFrame, lake: Lake, run_id: str, started: dt.datetime
) -> dict:
    """Move the partitions that passed into silver; the others are dropped with their staging."""
    staged = lake.staged_silver(run_id)
    passed = tables.listed_partitions(verdicts.filter("passed"), PARTITION)
    tables.promote(spark, staged, lake.silver, passed)
    storage.delete(spark, staged)
    stopped = verdicts.select(F.explode("reasons").alias("reason")).groupBy("reason").count()
    reasons = [f"{r['reason']}: {r['count']}" for r in stopped.orderBy("reason").collect()]
    return {
        "stage": "audit",
        "status": "PARTIAL" if reasons else "SUCCESS",
        "started_at": started,
        "ended_at": dt.datetime.now(dt.timezone.utc),
        "reason": ", ".join(reasons) or None,
        "run_id": run_id,
    }


# Partitions a backfill rewrites between two marks of its progress.
BACKFILL_GROUP = 200


def backfill(
    spark: SparkSession,
    lake: Lake,
    run_id: str,
    batch_dates: list[dt.date] | None = None,
    epoch_unit: str = "auto",
    exact: bool = True,
    gates: quality.Gates | None = None,
    group_size: int = BACKFILL_GROUP,
    most_groups: int | None = None,
) -> list[dict]:
    """Process bronze again, all batches or the given ones, in groups of partitions.

    A group is recorded when it is complete, the oldest days first. Calling it again with the same
    ``run_id``, after a failure or after ``most_groups``, goes on with what is not recorded.
    Repeating a group changes nothing. Returns the log entries of the groups of this call.
    """
    partitions = bronze.read(spark, lake.bronze).select(*PARTITION).distinct()
    if batch_dates is not None:
        partitions = partitions.filter(F.col("batch_date").isin(list(batch_dates)))
    done = backfilled(spark, lake, run_id)
    # Partition values as text, as many as Spark's own listing of the table keeps.
    open_ones = tables.listed_partitions(tables.without_keys(partitions, done, PARTITION), PARTITION)
    open_ones.sort(key=lambda values: (values["batch_date"] or "", values["symbol"] or ""))
    groups = [open_ones[at : at + group_size] for at in range(0, len(open_ones), group_size)]
    first = (done.agg(F.max("group")).first()[0] or 0) + 1
    entries = []
    for number, listed in enumerate(groups[:most_groups], first):
        group = spark.createDataFrame(
            [(v["symbol"], v["batch_date"]) for v in listed], "symbol string, batch_date string"
        ).select("symbol", F.col("batch_date").cast("date").alias("batch_date"))
        entries += refresh_from_bronze(spark, lake, group, run_id, epoch_unit, exact, gates)
        recorded = group.withColumns({"group": F.lit(number), "run_id": F.lit(run_id)})
        tables.replace_partitions(recorded, lake.backfills, ["run_id", "group"])
        # Each group is in the log as soon as it is done.
        runlog.append(spark, lake.run_log, entries[-3 if gates else -2 :])
    return entries


def backfilled(spark: SparkSession, lake: Lake, run_id: str) -> DataFrame:
    """symbol, batch_date and group of the partitions a backfill has completed."""
    fields = "symbol string, batch_date date, run_id string, group int"
    if not tables.exists(spark, lake.backfills):
        return tables.empty(spark, fields)
    return spark.read.schema(fields).parquet(lake.backfills).filter(F.col("run_id") == run_id)


def _bad_files(spark: SparkSession, lake: Lake, run_id: str) -> DataFrame:
    if not tables.exists(spark, lake.bad_files):
        return tables.empty(spark, "path string")
    return spark.read.parquet(lake.bad_files).filter(F.col("run_id") == run_id).select("path")


def _stopped(spark: SparkSession, lake: Lake, run_id: str) -> DataFrame:
    """The partitions that a gate kept from being published in this run."""
    if not tables.exists(spark, lake.gates):
        return tables.empty(spark, "symbol string, batch_date date")
    fields = "symbol string, batch_date date, passed boolean, run_id string"
    verdicts = spark.read.schema(fields).parquet(lake.gates)
    return verdicts.filter((F.col("run_id") == run_id) & ~F.col("passed")).select(*PARTITION)


def _record_files(spark: SparkSession, scans: DataFrame, lake: Lake, run_id: str) -> None:
    """Remember the loaded files; unreadable ones are tried again next time."""
    loaded = scans.filter(F.col("change").isin(CHANGE_TO_LOAD)).join(
        _bad_files(spark, lake, run_id), "path", "left_anti"
    )
    manifest.record(
        spark, lake.manifest, loaded.withColumn("ingested_at", F.current_timestamp())
    )


def _record_outcomes(
    spark: SparkSession, scans: DataFrame, expected: DataFrame, lake: Lake, run_id: str
) -> dict:
    """One outcome per expected (symbol, batch_date); returns the status row of the run."""
    bad = _bad_files(spark, lake, run_id).withColumn("is_bad", F.lit(True))
    stopped = _stopped(spark, lake, run_id).withColumn("is_stopped", F.lit(True))
    by_partition = (
        scans.join(bad, "path", "left")
        .groupBy(*PARTITION)
        .agg(
            F.count_if("is_bad").alias("bad_files"),
            F.count_if(F.col("change").isin(CHANGE_TO_LOAD)).alias("files_to_load"),
        )
    )
    outcome = (
        F.when(F.col("files_to_load").isNull(), runlog.MISSING_SOURCE)
        .when((F.col("bad_files") > 0) | F.col("is_stopped"), runlog.ERROR)
        .when(F.col("files_to_load") > 0, runlog.PROCESSED)
        .otherwise(runlog.SKIPPED_UNCHANGED)
    )
    outcomes = (
        expected.select(*PARTITION)
        .distinct()
        .join(by_partition, PARTITION, "left")
        .join(stopped, PARTITION, "left")
        .select(*PARTITION, outcome.alias("outcome"), F.lit(run_id).alias("run_id"))
    )
    tables.replace_partitions(outcomes, lake.outcomes, ["run_id"])
    stored = spark.read.schema(outcomes.schema).parquet(lake.outcomes)
    return runlog.run_status(stored.filter(F.col("run_id") == run_id)).first().asDict()
