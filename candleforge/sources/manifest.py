"""What has been ingested, what changed since, and what never arrived."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleforge.sources import tables

MANIFEST = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("batch_date", T.DateType()),
    ]
)

# Every file of every day is remembered, not only the last file of a symbol.
FILE_KEY = ["symbol", "batch_date", "file_name"]

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, empty when it does not exist yet."""
    if not tables.exists(spark, path):
        return tables.empty(spark, MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def record(spark: SparkSession, path: str, ingested: DataFrame) -> None:
    """Insert or replace the entries of ``ingested`` (MANIFEST columns)."""
    tables.upsert(
        spark, path, ingested.select(*MANIFEST.names), FILE_KEY, partition_by=["batch_date"]
    )


def detect_changes(
    scanned: DataFrame, manifest: DataFrame, keys: list[str] = FILE_KEY
) -> DataFrame:
    """Classify each scanned file against its manifest entry: new, changed or unchanged.

    Both sides are one narrow row per file, unique by ``keys``; Spark picks the join.
    """
    known = manifest.select(
        *[F.col(k).alias(f"_known_{k}") for k in keys], F.col("sha256").alias("_known_sha256")
    )
    same_file = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
    status = (
        F.when(F.col("_known_sha256").isNull(), NEW)
        .when(F.col("_known_sha256") == F.col("sha256"), UNCHANGED)
        .otherwise(CHANGED)
    )
    return (
        scanned.join(known, same_file, "left")
        .withColumn("change", status)
        .drop("_known_sha256", *[f"_known_{k}" for k in keys])
    )


def skip_unchanged(
    scanned: DataFrame, manifest: DataFrame, keys: list[str] = FILE_KEY
) -> DataFrame:
    """Only the files whose content is not in the manifest under their key."""
    return scanned.join(manifest.select(*keys, "sha256"), [*keys, "sha256"], "left_anti")


def expected_slots(
    symbols: DataFrame, first: Column, last: Column, step: str, name: str
) -> DataFrame:
    """One row per symbol and time slot; the slots are generated beside each symbol."""
    slots = F.sequence(first, last, F.expr(f"interval {step}"))
    return symbols.select("symbol").distinct().withColumn(name, F.explode(slots))


def expected_days(symbols: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return expected_slots(symbols, F.lit(first), F.lit(last), "1 day", "batch_date")


def missing_sources(
    expected: DataFrame, present: DataFrame, keys: list[str] = ["symbol", "batch_date"]
) -> DataFrame:
    """Expected keys with no file. Reports only; files that are present go on."""
    return expected.join(present.select(*keys).distinct(), keys, "left_anti")
