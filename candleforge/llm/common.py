"""What the text operators share: shared work tables, bounded slices of Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge import session

# Texts a task holds at a time, in bytes; one longer text is held alone.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the cluster's shared work folder and read again.

    This cuts the lineage with a copy that survives lost executors.
    """
    path = session.work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def bounded_sample(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most about ``per_class`` rows of each label (within 1 %), chosen by hash of doc_id.

    For fitting classifiers only. Rows with a null label are left out.
    """
    most = 0.95 * per_class
    # Only labels with more rows than that have a share below 1, so the list has at most rows / most.
    sizes = labelled.groupBy(F.col(label).alias("__label")).count().filter(F.col("count") > most)
    shares = sizes.select("__label", (most / F.col("count")).alias("__share"))
    shared = labelled.join(F.broadcast(shares), F.col(label) == F.col("__label"), "left")
    share = F.coalesce(F.col("__share"), F.lit(1.0))
    unit = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    known = F.col("doc_id").isNotNull() & F.col(label).isNotNull()
    return shared.filter(known & (unit < share)).drop("__label", "__share")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds about ``SLICE_BYTES`` of text or one row."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pa.compute.binary_length(texts).fill_null(0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > SLICE_BYTES:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)
    _give_back()


def _give_back() -> None:
    """Return freed memory to the system at the end of a task: its worker goes on in later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
