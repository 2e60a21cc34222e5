"""Bronze: the landed rows as text, with audit columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.schema import BRONZE, PARTITION, align
from candleforge.sources import tables


def with_audit(parsed: DataFrame, run_id: str, ingested_at: dt.datetime | None = None) -> DataFrame:
    """Name, hash, run and time of landing on every row (from file_name and sha256)."""
    at = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return (
        parsed.withColumnsRenamed(
            {"file_name": "_source_file_name", "sha256": "_source_file_sha256"}
        )
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .withColumn("_ingested_at", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    )


def write(bronze: DataFrame, target: str, from_files: bool = False) -> None:
    """Replace the (symbol, batch_date) partitions present in ``bronze``.

    Landing a day again therefore never doubles it. Partition values live in the path.
    Rows parsed ``from_files`` already sit together, file by file, and are written by the
    tasks that parsed them, without a shuffle.
    """
    tables.replace_partitions(align(bronze, BRONZE), target, PARTITION, rebalance=not from_files)


def read(spark: SparkSession, target: str, batch_date=None) -> DataFrame:
    return tables.read(spark, target, BRONZE, batch_date)
