"""Loads as files arrive: from landed zip files through bronze and silver to the candles.

The stream reads paths, hashes files in the JVM and keeps the last hash of every file name as its
state, so a file that arrives again with the same content is skipped, and one with other content
is loaded again, in whatever folder below the landing root it arrives. State and progress lie in
the checkpoint; a batch repeated after a failure lands the same rows again, which changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from candleforge.operators import bronze, quality
from candleforge.plans import daily_load
from candleforge.schema import BRONZE, PARTITION, align
from candleforge.sources import landing, tables
from candleforge.sources.manifest import FILE_KEY

_CHANGED = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("batch_date", T.DateType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("sha256", T.StringType()),
    ]
)


def arriving(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of (path, arrived, sha256, keys) of the zip files below ``root``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
    )
    hashed = files.select(
        "path", F.col("modificationTime").alias("arrived"), landing.fingerprint(F.col("content")).alias("sha256")
    )
    return landing.with_file_keys(hashed)


def changed_files(found: DataFrame) -> DataFrame:
    """The files whose content differs from that last seen under their key; the latest of a batch.

    The state is one hash for each file ever seen, kept by the key of the file.
    """

    def latest(key: tuple, portions: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = state.get[0] if state.exists else None
        last = None
        for portion in portions:
            newest = portion.sort_values(["arrived", "path"]).iloc[-1]
            if last is None or (newest["arrived"], newest["path"]) > (last["arrived"], last["path"]):
                last = newest
        if last is not None and last["sha256"] != known:
            state.update((last["sha256"],))
            yield pd.DataFrame([[*key, last["path"], last["sha256"]]], columns=_CHANGED.names)

    return found.groupBy(*FILE_KEY).applyInPandasWithState(
        latest, _CHANGED, "sha256 string", "append", GroupStateTimeout.NoTimeout
    )


def stream_load(
    spark: SparkSession,
    root: str,
    lake: daily_load.Lake,
    checkpoint: str,
    run_id: str,
    epoch_unit: str = "auto",
    exact: bool = True,
    gates: quality.Gates | None = None,
    files_per_batch: int = 1000,
    after_batch=None,
) -> StreamingQuery:
    """Load all files below ``root`` that are new or changed, up to the candles, then stop.

    A changed file replaces the bronze rows of its name; silver is upserted and the candles of
    the touched days are rebuilt. ``after_batch(files)`` is called with the loaded files (keys,
    path, sha256). An unreadable file is quarantined and changes nothing.
    """

    def load_batch(changed: DataFrame, batch_id: int) -> None:
        files = changed.persist()
        try:
            if not files.isEmpty():
                _land(files, f"{run_id}-{batch_id}")
                if after_batch is not None:
                    after_batch(files)
        finally:
            files.unpersist()

    def _land(files: DataFrame, batch_run: str) -> None:
        session, started = files.sparkSession, dt.datetime.now(dt.timezone.utc)
        # At most as many paths as a batch has files.
        paths = [row["path"] for row in files.select("path").collect()]
        content = session.read.format("binaryFile").load(paths).select("path", "content")
        rows = landing.parse_zipped_csv(content.join(F.broadcast(files), "path"))
        bad = landing.unreadable(rows)
        quality.write_quarantine(bad, lake.bad_files, batch_run)
        new = align(bronze.with_audit(landing.readable(rows), batch_run, started), BRONZE)
        touched = files.join(_bad_paths(session, lake, batch_run), "path", "left_anti")
        partitions = touched.select(*PARTITION).distinct()
        if touched.isEmpty():
            return
        if tables.exists(session, lake.bronze):
            held = tables.in_partitions(bronze.read(session, lake.bronze), partitions, PARTITION)
            replaced = touched.select(*PARTITION, F.col("file_name").alias("_source_file_name"))
            new = tables.without_keys(held, replaced, [*PARTITION, "_source_file_name"]).unionByName(new)
        bronze.write(new, lake.bronze)
        daily_load.refresh_from_bronze(session, lake, partitions, batch_run, epoch_unit, exact, gates)

    return (
        changed_files(arriving(spark, root, files_per_batch).filter("symbol is not null and batch_date is not null"))
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _bad_paths(spark: SparkSession, lake: daily_load.Lake, run_id: str) -> DataFrame:
    if not tables.exists(spark, lake.bad_files):
        return tables.empty(spark, "path string")
    fields = "path string, run_id string"
    return spark.read.schema(fields).parquet(lake.bad_files).filter(F.col("run_id") == run_id).select("path")
