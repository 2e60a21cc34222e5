"""Silver kept up to date from newly arriving bronze files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from candleforge.operators import silver
from candleforge.schema import BRONZE, PARTITION


def stream_upsert(
    spark: SparkSession,
    bronze_path: str,
    silver_target: str,
    checkpoint: str,
    run_id: str,
    epoch_unit: str = "auto",
    files_per_batch: int = 1000,
    after_batch=None,
) -> StreamingQuery:
    """Upsert all bronze files not seen yet, then stop.

    A batch repeated after a failure upserts the same keys again, which changes nothing.
    ``after_batch(partitions)`` may refresh dependent tables for the touched partitions.
    """

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        partitions = batch.select(*PARTITION).distinct()
        silver.upsert(
            batch.sparkSession, silver_target, batch, f"{run_id}-{batch_id}", epoch_unit, partitions
        )
        if after_batch is not None:
            after_batch(partitions)

    return (
        spark.readStream.schema(BRONZE)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(bronze_path)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
