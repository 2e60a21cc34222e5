"""Upkeep of partitioned tables: compaction, clustering, age tiers."""

from __future__ import annotations

import datetime as dt
import math
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleforge.functions import clock
from candleforge.session import session_conf
from candleforge.sources import tables

TARGET_FILE_BYTES = 256 << 20

# Bits of a column's range number in a curve: 2^CURVE_BITS ranges of about equally many rows.
CURVE_BITS = 10
# The rank of a bound is right within rows / CURVE_ACCURACY.
CURVE_ACCURACY = 100_000
# Beyond CURVE_ACCURACY, bounds are exact; a summary this accurate tells where to look for them.
BRACKET_ACCURACY = 10_000

# Tasks that write a compaction at most; more bins than these share writers.
MOST_WRITERS = 100_000
# Files up to which their list, a few hundred bytes each, is sent to every task that reads rows.
MOST_FILES_BROADCAST = 200_000

# Age limits in days and the folders they apply to.
COOL_AFTER_DAYS = 730
ARCHIVE_AFTER_DAYS = 1825
DELETE_AFTER_DAYS = 90
COOL_PREFIXES = ["bronze/raw/", "bronze/delta/"]
ARCHIVE_PREFIXES = ["bronze/raw/", "bronze/delta/", "archive/"]
DELETE_PREFIXES = ["bad-records/"]


def _placed(partition_by: list[str]) -> tuple[Column, Column]:
    """Folders below the table, and name, of the file that a row of a scan comes from."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folders = "/".join(f"{column}=[^/]*" for column in partition_by)
    return F.regexp_extract(path, f"({folders})/[^/]*$", 1), F.col("_metadata.file_name")


def _folder_value(column: str) -> Column:
    """The value, as text, that a folder of ``partition`` stands for."""
    written = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    value = F.url_decode(F.replace(written, F.lit("+"), F.lit("%2B")))
    return F.when(written != tables.NULL_FOLDER, value)


def file_sizes(spark: SparkSession, target: str, partition_by: list[str]) -> DataFrame:
    """Data files of a table: ``partition`` (folders below the table), ``file``, ``bytes`` and ``path``.

    Files are listed, none is opened.
    """
    partition, name = _placed(partition_by)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target)
    return files.select(
        partition.alias("partition"), name.alias("file"), F.col("length").alias("bytes"),
        F.col("_metadata.file_path").alias("path"),
    )


def packed(files: DataFrame, file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Add ``bin``: which files of a ``partition`` fit together into one of about ``file_bytes``.

    Files of at least that size have a bin of their own (null). The others are laid end to end,
    the largest first, and cut at multiples of the size, so a bin but the last holds between a half
    and one and a half of it.
    """
    # Large files go last: they do not take part in the running sum.
    is_small = F.col("bytes") < file_bytes
    order = Window.partitionBy("partition").orderBy(~is_small, F.desc("bytes"), "file")
    start = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.coalesce(start, F.lit(0))
    number = ((whole - F.pmod(whole, F.lit(file_bytes))) / file_bytes).cast("long")
    return files.withColumn("bin", F.when(is_small, number))


def crowded(files: DataFrame, file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Partitions whose files fit into half as many: ``files``, ``bytes`` and ``bins`` of them.

    What compaction writes fits its bins, so a partition is not chosen again until it has
    collected as many small files anew.
    """
    by_partition = packed(files, file_bytes).groupBy("partition").agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        (F.count_distinct("bin") + F.count_if(F.col("bin").isNull())).alias("bins"),
    )
    return by_partition.filter(F.col("files") >= 2 * F.col("bins"))


def compact(
    spark: SparkSession,
    target: str,
    partition_by: list[str],
    partitions: DataFrame | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite partitions of many small files, by default any of the table; returns how many.

    Which ones, and which of their files go together, follows from a listing of file sizes. Well
    laid partitions are not touched, so calling it again rewrites nothing. The rows stay the
    same. A catalog table, whose files are not listed, is rewritten as chosen by ``partitions``.
    """
    table = _chosen(spark, target, partition_by, partitions)
    if not tables.is_path(target):
        with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=file_bytes):
            tables.replace_partitions(table, target, partition_by)
        return table.select(*partition_by).distinct().count()
    if not partition_by:
        raise ValueError("a table without partitions cannot be rewritten in place")
    listed = file_sizes(spark, target, partition_by)
    few = crowded(listed, file_bytes)
    values = few.select(*[_folder_value(c).alias(c) for c in partition_by])
    if partitions is not None:
        values = tables.in_partitions(values, partitions, partition_by)
    chosen = tables.partition_filter(values, partition_by)
    if chosen is tables.NO_PARTITION:
        return 0
    # Counted now: listings are taken anew after files were replaced.
    rewritten = values.distinct().count()
    bins = packed(listed, file_bytes).join(few, "partition", "left_semi")
    # A large file of a chosen partition stays a file of its own.
    of_file = bins.select(
        F.col("path").alias("_path"),
        F.col("partition").alias("_partition"),
        F.coalesce(F.concat(F.lit("bin "), F.col("bin")), "file").alias("_bin"),
    )
    counted = of_file.agg(F.count("*").alias("files"), F.count_distinct("_partition", "_bin").alias("bins")).first()
    writers = min(MOST_WRITERS, 4 * counted["bins"])
    if counted["files"] <= MOST_FILES_BROADCAST:
        of_file = F.broadcast(of_file)
    rows = table.withColumn("_path", F.col("_metadata.file_path")).filter(chosen)
    gathered = rows.join(of_file, "_path").repartition(writers, "_partition", "_bin")
    written = gathered.drop("_path", "_partition", "_bin")
    # A task has a few bins at most. With a writer for each, rows are not sorted by partition first.
    with session_conf(spark, spark__sql__maxConcurrentOutputFileWriters=tables.OPEN_WRITERS):
        tables.replace_partitions(written, target, partition_by, rebalance=False)
    return rewritten


def cluster_by(
    spark: SparkSession,
    target: str,
    partition_by: list[str],
    columns: list[str],
    partitions: DataFrame | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
    curve: bool = False,
    ranges: int | None = None,
) -> None:
    """Rewrite the chosen partitions ordered by ``columns``, for tight file statistics.

    Ranges are cut over partition and clustering columns together, so a partition with a
    third of all rows spreads over as many writers as its size asks for. A sort by several
    columns narrows files by the first alone; with ``curve`` rows follow a space-filling curve
    through all of them, which narrows files by each column. Files come near ``file_bytes``, or
    the rows are cut into ``ranges`` files.
    """
    table = _chosen(spark, target, partition_by, partitions)
    order = [*partition_by, *columns]
    if curve:
        order = [*partition_by, CURVE]
        table = with_curve(table, columns)
    dealt = table.repartitionByRange(*([ranges] if ranges else []), *order)
    ordered = dealt.sortWithinPartitions(*order).drop(CURVE)
    with session_conf(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=file_bytes,
        # Files of the wanted size go before as many writers as there are cores.
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    ):
        tables.replace_partitions(ordered, target, partition_by, rebalance=False)


CURVE = "_curve"


def sortable(column: Column, kind: T.DataType) -> Column:
    """A number in the order of the column; of texts the first seven bytes decide."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        leading = F.substring(F.hex(column.cast("binary")), 1, 14)
        return F.conv(F.rpad(leading, 14, "0"), 16, 10).cast("long")
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    return column


def range_bounds(table: DataFrame, columns: list[str], bits: int = CURVE_BITS,
                 accuracy: int = CURVE_ACCURACY) -> dict[str, Column | None]:
    """For each column 2^bits - 1 quantiles, as a literal array.

    A quantile's rank is right within rows / ``accuracy``. A column without values has none. One
    aggregate over those columns finds them; its summary, which one task merges, is as long as
    ``accuracy``. For a higher one than CURVE_ACCURACY exact quantiles are taken instead.
    """
    shares = [n / (1 << bits) for n in range(1, 1 << bits)]
    types = {f.name: f.dataType for f in table.schema}
    values = {c: sortable(F.col(c), types[c]) for c in columns}
    if accuracy > CURVE_ACCURACY:
        row = {c: exact_quantiles(table.select(value.alias("value")), shares) for c, value in values.items()}
    else:
        found = table.agg(
            *[F.percentile_approx(value, shares, accuracy).alias(c) for c, value in values.items()]
        )
        row = found.first()  # arrays of fixed length
    return {c: F.array(*map(F.lit, row[c])) if row[c] else None for c in columns}


def exact_quantiles(values: DataFrame, shares: list[float]) -> list | None:
    """The values of rank ceil(share * count) of the only column ``value``; None without values.

    A rough summary gives an interval of values around each quantile. All rows are counted by
    interval, and only values inside one are counted singly, so no task sees more than a small
    share of the rows. Intervals that turn out to miss their rank are taken wider.
    """
    values = values.filter(F.col("value").isNotNull())
    kind, slack = values.schema["value"].dataType, 2 / BRACKET_ACCURACY
    while True:
        found = _ranked(values, kind, shares, _intervals(values, shares, slack))
        if found is None or all(rank in found for rank in range(len(shares))):
            return found and [found[rank] for rank in range(len(shares))]
        slack *= 16


def _intervals(values: DataFrame, shares: list[float], slack: float) -> list[tuple]:
    """Disjoint intervals of values, in order, that hold the quantiles; none if slack covers all rows."""
    if slack >= 1:
        return []
    ends = [min(1.0, max(0.0, share + side)) for share in shares for side in (-slack, slack)]
    row = values.agg(F.percentile_approx("value", ends, BRACKET_ACCURACY).alias("ends")).first()
    found = row["ends"] or []
    joined: list[tuple] = []
    for low, high in zip(found[::2], found[1::2]):
        if joined and low <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    return joined


def _ranked(values: DataFrame, kind: T.DataType, shares: list[float], intervals: list[tuple]) -> dict | None:
    """Quantiles by their number in ``shares``, as far as they lie inside the intervals (none: all values)."""
    value = F.col("value")
    if intervals:
        # As many intervals begin at or below the value.
        at = F.lit(0)
        for number, (low, _) in enumerate(intervals, 1):
            at = F.when(value >= F.lit(low).cast(kind), number).otherwise(at)
        highs = F.array(*[F.lit(high).cast(kind) for _, high in intervals])
        inside = F.when(F.col("at") > 0, value <= F.element_at(highs, F.greatest("at", F.lit(1)))).otherwise(False)
    else:
        at, inside = F.lit(1), F.lit(True)
    placed = values.withColumn("at", at).withColumn("inside", inside)
    counts = placed.groupBy("at", "inside", F.when(F.col("inside"), value).alias("value")).agg(
        F.count("*").alias("rows")
    )
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Two rows for each interval at most.
        totals = {(r["at"], r["inside"]): r["rows"] for r in
                  counts.groupBy("at", "inside").agg(F.sum("rows").alias("rows")).collect()}
        total = sum(totals.values())
        if not total:
            return None
        wanted, below = [], 0
        for n in range(len(intervals) + 1 if intervals else 2):
            held = totals.get((n, True), 0)
            for number, share in enumerate(shares):
                rank = max(1, math.ceil(share * total)) - below
                if 1 <= rank <= held:
                    wanted.append(F.struct(F.lit(n).alias("at"), F.lit(number).alias("number"), F.lit(rank).alias("rank")))
            below += held + totals.get((n, False), 0)
        if not wanted:
            return {}
        order = Window.partitionBy("at").orderBy("value")
        upto = counts.filter("inside").withColumn("upto", F.sum("rows").over(order))
        ranks = F.filter(
            F.array(*wanted),
            lambda w: (w["at"] == F.col("at"))
            & (w["rank"] <= F.col("upto")) & (w["rank"] > F.col("upto") - F.col("rows")),
        )
        hit = upto.select("value", F.explode(ranks["number"]).alias("number"))
        return {r["number"]: r["value"] for r in hit.collect()}
    finally:
        counts.unpersist()


def range_number(value: Column, bounds: Column | None, bits: int = CURVE_BITS) -> Column:
    """How many bounds lie below the value, by bisection; 0 for null."""
    if bounds is None:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(bits))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.element_at(bounds, at + step) < value, step).otherwise(0),
    )


def interleaved(numbers: list[Column], bits: int = CURVE_BITS) -> Column:
    """The numbers' bits dealt in turn into one long, the highest bits first (a Z-order curve)."""
    if bits * len(numbers) > 62:
        raise ValueError(f"{len(numbers)} columns of {bits} bits do not fit a long")
    dealt = F.lit(0).cast("long")
    for bit in range(bits):
        for n, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            dealt = dealt.bitwiseOR(F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - n))
    return dealt


def with_curve(table: DataFrame, columns: list[str], bits: int = CURVE_BITS, name: str = CURVE,
               accuracy: int = CURVE_ACCURACY) -> DataFrame:
    """Add each row's place on the curve through ``columns``.

    A column counts by its ranks, so skewed and wide-spread values are cut as finely as others.
    """
    types = {f.name: f.dataType for f in table.schema}
    bounds = range_bounds(table, columns, bits, accuracy)
    ranges = {
        f"_range{n}": range_number(sortable(F.col(c), types[c]), bounds[c], bits)
        for n, c in enumerate(columns)
    }
    placed = table.withColumns(ranges)
    return placed.withColumn(name, interleaved([F.col(r) for r in ranges], bits)).drop(*ranges)


def column_spread(table: DataFrame, columns: list[str]) -> DataFrame:
    """Per file and column: rows, and the share of the table's value range between its ends.

    The smaller the share, the more files a filter on the column skips. Numbers, dates and times.
    """

    def number(column: str) -> Column:
        kind = table.schema[column].dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
        return F.col(column).cast("double")

    ends = [f(number(c)).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    per_file = table.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), *ends)
    overall = per_file.agg(
        *[F.min(f"min_{c}").alias(f"low_{c}") for c in columns],
        *[F.max(f"max_{c}").alias(f"high_{c}") for c in columns],
    )
    shares = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(
                (F.col(f"max_{c}") - F.col(f"min_{c}"))
                / F.nullif(F.col(f"high_{c}") - F.col(f"low_{c}"), F.lit(0.0)),
                F.lit(0.0),
            ).alias("share"),
        )
        for c in columns
    ]
    # One row, so it is broadcast.
    joined = per_file.crossJoin(F.broadcast(overall))
    return joined.select("file", "rows", F.inline(F.array(*shares)))


def _chosen(
    spark: SparkSession, target: str, partition_by: list[str], partitions: DataFrame | None
) -> DataFrame:
    # Partition values keep their text, so that 007 stays 007.
    with session_conf(spark, spark__sql__sources__partitionColumnTypeInference__enabled="false"):
        table = tables.read(spark, target)
    if partitions is not None:
        table = tables.in_partitions(table, partitions, partition_by)
    return table


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Files under ``root`` with size and modification time; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


def tier_report(objects: DataFrame, as_of: dt.date, path: str = "path",
                modified: str = "modificationTime") -> DataFrame:
    """Add ``age_days`` and ``tier``: what the age rules would do with each object.

    ``path`` is relative to the lake. The strongest rule wins; no rule means hot.
    """
    age = clock.age_in_days(F.col(modified).cast("date"), F.lit(as_of))

    def under(prefixes: list[str]) -> Column:
        return reduce(Column.__or__, [F.startswith(F.col(path), F.lit(p)) for p in prefixes])

    tier = (
        F.when(under(DELETE_PREFIXES) & (age > DELETE_AFTER_DAYS), "delete")
        .when(under(ARCHIVE_PREFIXES) & (age > ARCHIVE_AFTER_DAYS), "archive")
        .when(under(COOL_PREFIXES) & (age > COOL_AFTER_DAYS), "cool")
        .otherwise("hot")
    )
    return objects.withColumn("age_days", age).withColumn("tier", tier)
