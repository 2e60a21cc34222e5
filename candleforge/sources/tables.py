"""Partitioned parquet tables: read, replace partitions, keyed upsert.

A target is a path (it contains ``/``) or a catalog table name. Writers replace whole
partitions (dynamic overwrite): output is staged by the tasks and moved into place when
the job commits, so a lost executor or a retried task leaves the table as it was. The
move itself is not a transaction: readers that list files during it can see a mix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleforge.session import session_conf
from candleforge.sources import storage

# Files that a task keeps open when it writes rows of few partitions unsorted; each holds a row
# group. A task that meets more sorts the rest of its rows.
OPEN_WRITERS = 16

# The filter of an empty list of partitions.
NO_PARTITION = object()


class DuplicateKeys(ValueError):
    """An upsert source holds two rows for one key."""


def is_path(target: str) -> bool:
    return "/" in target


def exists(spark: SparkSession, target: str) -> bool:
    if not is_path(target):
        return spark.catalog.tableExists(target)
    return storage.has_data(spark, target)


def read(
    spark: SparkSession, target: str, schema: T.StructType | None = None, batch_date=None
) -> DataFrame:
    """The table, or one batch of it; an empty ``batch_date`` means all batches.

    With a schema a path is opened without inference and partition values keep their
    declared type. The date is compared as a date literal, so folders are pruned.
    """
    if is_path(target):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        table = reader.parquet(target)
    else:
        table = spark.table(target)
    if batch_date:
        table = table.filter(F.col("batch_date") == F.lit(batch_date).cast("date"))
    return table


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of the schema, without the Python workers that a local list is sent through."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def read_evolved(spark: SparkSession, target: str, newer: T.StructType) -> DataFrame:
    """The stored table with the columns of ``newer`` added and its partition types used."""
    if not is_path(target):
        return spark.table(target)
    stored = spark.read.parquet(target).schema
    names = set(newer.names)
    schema = T.StructType(newer.fields + [f for f in stored if f.name not in names])
    return spark.read.schema(schema).parquet(target)


def laid_out(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Bring rows of one partition together, splitting those that exceed the target size.

    Adaptive execution cuts a large partition into several tasks and merges small ones,
    so one hot symbol does not end up in a single writer and a cold one in many files.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def replace_partitions(
    df: DataFrame, target: str, partition_by: list[str], rebalance: bool = True
) -> None:
    """Write ``df``; partitions it holds are replaced, all others stay."""
    spark = df.sparkSession
    if rebalance:
        df = laid_out(df, partition_by)
    # The mode is set on the writer: other writes of the session do not share it.
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if is_path(target):
        writer.partitionBy(*partition_by).parquet(target)
    elif spark.catalog.tableExists(target):
        with session_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
            df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        spark.catalog.refreshTable(target)
    else:
        df.write.format("parquet").partitionBy(*partition_by).saveAsTable(target)


def rebuild(df: DataFrame, target: str, partition_by: list[str]) -> None:
    """Write ``df`` as the whole table, dropping whatever was there."""
    writer = (
        laid_out(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
    )
    if is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def listed_partitions(partitions: DataFrame, partition_by: list[str]) -> list[dict]:
    """Partition values as text; as many as Spark's own file listing keeps on the driver."""
    names = [F.col(c).cast("string") for c in partition_by]
    return [row.asDict() for row in partitions.select(*names).distinct().collect()]


# How partition folders write a missing value, and the characters they escape.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


def folder_text(value: str | None) -> str:
    """A partition value as part of a folder name."""
    if not value:
        return NULL_FOLDER
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or c < " " else c for c in value)


def drop_partitions(spark: SparkSession, target: str, listed: list[dict]) -> None:
    """Remove partitions; absent ones are ignored. List them before replacing files."""
    for values in listed:
        if not is_path(target):
            spec = ", ".join(f"`{c}` = '{value}'" for c, value in values.items())
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")
            continue
        folder = "/".join(f"{c}={folder_text(value)}" for c, value in values.items())
        storage.delete(spark, f"{target.rstrip('/')}/{folder}", parents=len(values) - 1)


def partition_filter(partitions: DataFrame, columns: list[str]) -> Column | object:
    """A literal filter for the listed partitions, which prunes folders before the scan.

    For an empty list it is ``NO_PARTITION``, which callers may test for by identity. The
    list on the driver is as long as the one that Spark's own file listing keeps of the
    table. Values are compared as text, nulls included, so the filter is never null.
    """
    types = {f.name: f.dataType.simpleString() for f in partitions.schema}
    # char(0) stands for null and char(1) separates: neither occurs in a folder name.
    texts = [f"coalesce(cast(cast(`{c}` as {types[c]}) as string), char(0))" for c in columns]
    value = f"concat_ws(char(1), {', '.join(texts)})"
    listed = [row[0] for row in partitions.select(F.expr(value)).distinct().collect()]
    if not listed:
        return NO_PARTITION
    return F.expr(f"{value} IN ({', '.join(map(_literal, listed))})")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_partitions(df: DataFrame, partitions: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``df`` in the listed partitions, by a filter on literals."""
    chosen = partition_filter(partitions, columns)
    return df.limit(0) if chosen is NO_PARTITION else df.filter(chosen)


def without_keys(df: DataFrame, replaced: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``replaced``; null keys match null keys."""
    gone = replaced.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return df.join(gone, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_anti")


def merged(
    current: DataFrame,
    source: DataFrame,
    keys: list[str],
    source_keys=None,
    unnamed: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """``current`` with ``source`` upserted: matched rows replaced, the others inserted.

    Columns that only one side has are null on the other. ``source_keys`` may give the
    source's keys from a cheaper plan; only those columns are shuffled for the match, the
    source rows themselves are not. ``unnamed`` names the id column and the columns that
    tell rows without an id apart: such a row is only replaced by one with the same content.
    """
    incoming = source if source_keys is None else source_keys
    if unnamed is None:
        kept = without_keys(current, incoming, keys)
    else:
        no_id, content = F.col(unnamed[0]).isNull(), unnamed[1]
        kept = without_keys(current.filter(~no_id), incoming.filter(~no_id), keys).unionByName(
            without_keys(current.filter(no_id), source.filter(no_id), content)
        )
    return kept.unionByName(source, allowMissingColumns=True)


def reject_duplicate_keys(source: DataFrame, keys: list[str]) -> None:
    """Fail like MERGE does when one key has several source rows."""
    repeated = source.groupBy(*keys).count().filter(F.col("count") > 1).limit(5).collect()
    if repeated:
        raise DuplicateKeys(f"several source rows for {[row.asDict() for row in repeated]}")


def upsert(
    spark: SparkSession,
    target: str,
    source: DataFrame,
    keys: list[str],
    partition_by: list[str],
    partitions: DataFrame | None = None,
    source_keys: DataFrame | None = None,
    check_keys: bool = True,
    grouped: bool = False,
    observe=None,
    unnamed: tuple[str, list[str]] | None = None,
    into: str | None = None,
) -> None:
    """Upsert ``source`` into ``target`` by ``keys``, creating the table if absent.

    Only partitions the source touches are read and rewritten, and only those the target
    already holds are matched. ``partitions`` may name the touched ones from a cheaper
    plan. Pass ``check_keys=False`` for a source that is unique by construction, and
    ``grouped=True`` for one whose input files hold few partitions each: partitions new
    to the target are then written without a shuffle. ``observe`` maps the final rows to
    the rows to write, in the writing stage. With ``into`` the new state of the touched
    partitions is written there and the target stays as it is (see ``promote``).
    """
    if check_keys:
        reject_duplicate_keys(source, keys)
    fresh, matched = source, None
    if exists(spark, target):
        touched = partitions if partitions is not None else source
        stored = read_evolved(spark, target, source.schema)
        current = in_partitions(stored, touched, partition_by)
        held = partition_filter(current, partition_by)
        incoming = source_keys if source_keys is not None else source.select(*keys)
        if held is not NO_PARTITION:
            fresh = source.filter(~held)
            matched = merged(
                current, source.filter(held), keys, incoming.filter(held), unnamed
            )
    parts = [fresh if grouped else laid_out(fresh, partition_by)]
    if matched is not None:
        parts.append(laid_out(matched, partition_by))
    result = union_all(parts)
    if observe is not None:
        result = observe(result)
    replace_partitions(result, into or target, partition_by, rebalance=False)


def promote(spark: SparkSession, staged: str, target: str, listed: list[dict]) -> None:
    """Move the listed partitions from ``staged`` into ``target``, in place of those it holds.

    Files are moved, not rewritten, one folder after the other, like a commit of Spark's own
    dynamic overwrite. A run that dies in between leaves whole partitions, old or new; calling
    it again moves the rest.
    """
    for values in listed:
        folder = "/".join(f"{c}={folder_text(value)}" for c, value in values.items())
        storage.move(spark, f"{staged.rstrip('/')}/{folder}", f"{target.rstrip('/')}/{folder}")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
