"""Run outcomes: status, log table, metrics, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleforge.functions import parsing
from candleforge.sources import tables

# Outcomes of one file, statuses of a run, days a log entry is kept.
PROCESSED = "processed"
SKIPPED_UNCHANGED = "skipped_unchanged"
MISSING_SOURCE = "missing_source"
ERROR = "error"
LOG_DAYS = 50

RUN_LOG = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("duplicates_dropped", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("reason", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)


def status_of(processed: Column, skipped: Column, missing: Column, errors: Column,
              expected: Column) -> Column:
    """Status of a run from its counts; the first matching line wins."""
    nothing_done = processed == 0
    return (
        F.when((errors > 0) & nothing_done & (skipped == 0), "FAILED")
        .when(errors > 0, "PARTIAL")
        .when(nothing_done & (missing == expected), "WAITING_SOURCE")
        .when(nothing_done, "SKIPPED")
        .otherwise("SUCCESS")
    )


def run_status(outcomes: DataFrame) -> DataFrame:
    """One row per run from one row per (run_id, expected file) with its ``outcome``."""

    def counted(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome)

    counts = outcomes.groupBy("run_id").agg(
        F.count("*").alias("expected"),
        counted(PROCESSED).alias("processed"),
        counted(SKIPPED_UNCHANGED).alias("skipped_unchanged"),
        counted(MISSING_SOURCE).alias("missing_source"),
        counted(ERROR).alias("errors"),
    )
    status = status_of(
        F.col("processed"), F.col("skipped_unchanged"), F.col("missing_source"),
        F.col("errors"), F.col("expected"),
    )
    return counts.withColumn("status", status)


def append(spark: SparkSession, target: str, entries: list[dict]) -> None:
    """Add log entries (RUN_LOG fields); one small file per run and stage."""
    rows = [tuple(entry.get(name) for name in RUN_LOG.names) for entry in entries]
    writer = spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append")
    if tables.is_path(target):
        writer.partitionBy("run_id").parquet(target)
    else:
        writer.format("parquet").partitionBy("run_id").saveAsTable(target)


def read(spark: SparkSession, target: str) -> DataFrame:
    return tables.read(spark, target, RUN_LOG)


class WriteMetrics:
    """Counts taken while a table is written, without a further scan.

    Attach in the writing stage: a task there is counted once however often it ran.
    """

    def __init__(self, **measures: Column):
        self._measures = measures
        self._observation = Observation()

    def attach(self, df: DataFrame) -> DataFrame:
        return df.observe(
            self._observation, *[column.alias(name) for name, column in self._measures.items()]
        )

    def values(self) -> dict:
        return self._observation.get


def retention(
    log: DataFrame, as_of: dt.date, keep_days: int = LOG_DAYS, run_id: str = "run_id"
) -> DataFrame:
    """Classify entries by the date their run id starts with: keep, delete or skip.

    An id without a date is skipped, that is kept.
    """
    cutoff = as_of - dt.timedelta(days=keep_days)
    day = parsing.date_prefix(F.col(run_id))
    action = F.when(day.isNull(), "skip").when(day < F.lit(cutoff), "delete").otherwise("keep")
    return log.withColumn("run_date", day).withColumn("retention", action)


def retained(log: DataFrame, as_of: dt.date, keep_days: int = LOG_DAYS) -> DataFrame:
    classified = retention(log, as_of, keep_days)
    return classified.filter(F.col("retention") != "delete").drop("run_date", "retention")


def expire(spark: SparkSession, target: str, as_of: dt.date, keep_days: int = LOG_DAYS) -> None:
    """Remove the log partitions of expired runs."""
    classified = retention(read(spark, target), as_of, keep_days)
    expired = classified.filter(F.col("retention") == "delete")
    tables.drop_partitions(spark, target, tables.listed_partitions(expired, ["run_id"]))
