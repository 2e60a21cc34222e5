"""Landed zip files: scan, fingerprint, keys from the name, rows of the CSV inside.

A zip cannot be split, so the unit of parallelism is the file. Everything about a file
except its rows (name, hash, change status) is computed in the JVM; only unzipping and
CSV decoding run in Python, on Arrow batches.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import re
import sys
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleforge.schema import PARTITION, TRADE_FILE_COLUMNS
from candleforge.sources import storage
from candleforge.sources.tables import in_partitions

# Send the decoder itself to the tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values: <symbol>-aggTrades-<day>.zip, with an optional part number.
FILE_NAME = r"^([A-Z0-9]+)-aggTrades-(\d{4}-\d{2}-\d{2})(?:-\d+)?\.zip$"

# Cells read as missing.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

BLOCK_BYTES = 8 << 20
LEAST_BLOCK_BYTES = 64 << 10

INTEGER = re.compile(r"[+-]?\d+")

PARSE_ERROR = "_parse_error"
EXTRA_CELLS = "_has_extra_cells"
FILE_ROWS = "_file_rows"


def file_name_of(path: str) -> Column:
    return F.element_at(F.split(F.col(path), "/"), -1)


def landed_files(
    spark: SparkSession,
    root: str,
    batch_dates: list[dt.date] | None = None,
    partitions: DataFrame | None = None,
    with_content: bool = True,
) -> DataFrame:
    """One row per zip under ``root``: path, size, modification time, bytes and keys.

    The keys come from ``symbol=X/batch_date=Y/`` folders, or else from the file names.
    ``batch_dates`` limits what is listed, ``partitions`` (symbol, batch_date) what is
    opened. Without content only the listing is read.
    """
    files = _open(spark, root, batch_dates)
    columns = ["path", "modificationTime", "length"] + (["content"] if with_content else [])
    if set(PARTITION) <= set(files.columns):
        files = files.select(
            *columns,
            file_name_of("path").alias("file_name"),
            F.col("symbol").cast("string").alias("symbol"),
            F.col("batch_date").cast("date").alias("batch_date"),
        )
    else:
        files = with_file_keys(files.select(*columns))
    if batch_dates is not None:
        files = files.filter(F.col("batch_date").isin(list(batch_dates)))
    if partitions is not None:
        files = in_partitions(files, partitions, PARTITION)
    return files


def _open(spark: SparkSession, root: str, batch_dates: list[dt.date] | None) -> DataFrame:
    reader = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("basePath", root)
    )
    if batch_dates:
        days = ",".join(str(day) for day in batch_dates)
        of_these_days = f"{root.rstrip('/')}/symbol=*/batch_date={{{days}}}"
        if storage.matches(spark, of_these_days):
            return reader.load(of_these_days)
    return reader.load(root)


def with_file_keys(files: DataFrame, path: str = "path") -> DataFrame:
    """Add ``file_name``, ``symbol`` and ``batch_date``; keys are null for a foreign name."""
    symbol = F.regexp_extract("file_name", FILE_NAME, 1)
    return (
        files.withColumn("file_name", file_name_of(path))
        .withColumn("symbol", F.when(symbol != "", symbol))
        .withColumn(
            "batch_date",
            F.try_to_timestamp(
                F.regexp_extract("file_name", FILE_NAME, 2), F.lit("yyyy-MM-dd")
            ).cast("date"),
        )
    )


def fingerprint(content: Column) -> Column:
    """SHA-256 in hex; accepts bytes or text."""
    return F.sha2(content.cast("binary"), 256)


def with_fingerprint(files: DataFrame, content: str = "content") -> DataFrame:
    return files.withColumn("sha256", fingerprint(F.col(content)))


def parse_zipped_csv(files: DataFrame, checked: bool = False) -> DataFrame:
    """Rows of the first ``.csv`` member of each zip, all text, in canonical column order.

    ``files`` has ``content``; its other columns are repeated on every row. A file that
    cannot be read gives exactly one row, with ``_parse_error`` set and no trade cells.
    Rows narrower than the canonical columns are padded with nulls, wider ones lose the
    surplus cells and are marked in ``_has_extra_cells``. Files known to be readable by
    ``check_zipped_csv`` may be passed as ``checked``; they are decoded once.
    """
    carried = [f for f in files.schema if f.name != "content"]
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in TRADE_FILE_COLUMNS]
        + [
            T.StructField(EXTRA_CELLS, T.BooleanType()),
            T.StructField(PARSE_ERROR, T.StringType()),
        ]
        + carried
    )
    carried_names = [f.name for f in carried]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = batch.column("content")
            for i in range(batch.num_rows):
                keep = [batch.column(name).slice(i, 1) for name in carried_names]
                for cells in _file_batches(content[i].as_buffer(), checked):
                    # Repeat the file's own columns on each of its rows.
                    index = pa.repeat(pa.scalar(0, pa.int64()), cells.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [*cells.columns, *(column.take(index) for column in keep)],
                        names=[*cells.schema.names, *carried_names],
                    )

    return files.select("content", *carried_names).mapInArrow(decode, schema)


def check_zipped_csv(files: DataFrame) -> DataFrame:
    """One row per file instead of its content: is it readable, how many rows, any surplus cells."""
    carried = [f for f in files.schema if f.name != "content"]
    found = [
        T.StructField(FILE_ROWS, T.LongType()),
        T.StructField(EXTRA_CELLS, T.BooleanType()),
        T.StructField(PARSE_ERROR, T.StringType()),
    ]
    names = [f.name for f in carried]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [_check(content.as_buffer()) for content in batch.column("content")]
            types = (pa.int64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(column, kind) for column, kind in zip(zip(*results), types)],
                names=[*names, FILE_ROWS, EXTRA_CELLS, PARSE_ERROR],
            )

    return files.select("content", *names).mapInArrow(check, T.StructType(carried + found))


def _check(content: pa.Buffer) -> tuple[int, bool, str | None]:
    rows, extra = 0, False
    try:
        for cells in _member_batches(content):
            rows += cells.num_rows
            extra = extra or cells.column(EXTRA_CELLS).true_count > 0
    except Exception as error:  # whatever is wrong with a file, it must not stop the others
        return 0, False, f"{type(error).__name__}: {error}"
    return rows, extra, None


def _file_batches(content: pa.Buffer, checked: bool) -> Iterator[pa.RecordBatch]:
    """Text batches of one zip, or a single error row: a file counts whole or not at all.

    Without a check before, a member is decoded to its end first and then again, so that none
    is held whole.
    """
    error = None if checked else _check(content)[2]
    if error is None:
        yield from _member_batches(content)
    else:
        yield error_batch(error)


def error_batch(error: str) -> pa.RecordBatch:
    """The single row of an unreadable file."""
    return _cells_batch([[None] * len(TRADE_FILE_COLUMNS)], False, error)


def _member_batches(content: pa.Buffer) -> Iterator[pa.RecordBatch]:
    return member_batches(pa.BufferReader(content))


def member_batches(source) -> Iterator[pa.RecordBatch]:
    """Text batches of the first ``.csv`` member of a zip, from a file to seek and read in."""
    with zipfile.ZipFile(source) as archive:
        member = next((m for m in archive.infolist() if m.filename.endswith(".csv")), None)
        if member is None:
            raise ValueError("no member of the archive ends in .csv")
        yield from _csv_batches(archive, member)


def _csv_batches(archive: zipfile.ZipFile, member: zipfile.ZipInfo) -> Iterator[pa.RecordBatch]:
    skip, width = _sniff(archive, member)
    if width == 0:
        return
    names = [f"c{i}" for i in range(width)]
    ragged: list[str] = []

    def set_aside(row: pacsv.InvalidRow) -> str:
        ragged.append(row.text)
        return "skip"

    # A short member does not ask for a whole block.
    block = min(BLOCK_BYTES, max(member.file_size + 1, LEAST_BLOCK_BYTES))
    with archive.open(member) as stream:
        reader = pacsv.open_csv(
            stream,
            read_options=pacsv.ReadOptions(
                column_names=names, skip_rows=skip, block_size=block, use_threads=False
            ),
            parse_options=pacsv.ParseOptions(invalid_row_handler=set_aside),
            convert_options=pacsv.ConvertOptions(
                column_types={name: pa.string() for name in names},
                null_values=MISSING_CELLS,
                strings_can_be_null=True,
            ),
        )
        for batch in reader:
            if batch.num_rows:
                yield _canonical(batch)
            if ragged:
                yield from _ragged_batches(ragged)
                ragged.clear()
    if ragged:
        yield from _ragged_batches(ragged)


def _sniff(archive: zipfile.ZipFile, member: zipfile.ZipInfo) -> tuple[int, int]:
    """Lines before the first data row, and the number of cells of the first filled line."""
    with archive.open(member) as stream:
        for number, line in enumerate(stream):
            text = line.decode("utf-8-sig", errors="replace").strip()
            if text:
                cells = next(csv.reader([text]))
                is_header = INTEGER.fullmatch(cells[0].strip().strip('"')) is None
                return number + int(is_header), len(cells)
    return 0, 0


def _canonical(batch: pa.RecordBatch) -> pa.RecordBatch:
    size = len(TRADE_FILE_COLUMNS)
    columns = batch.columns[:size]
    columns += [pa.nulls(batch.num_rows, pa.string())] * (size - len(columns))
    extra = pa.repeat(pa.scalar(batch.num_columns > size), batch.num_rows)
    return pa.RecordBatch.from_arrays(
        [*columns, extra, pa.nulls(batch.num_rows, pa.string())],
        names=[*TRADE_FILE_COLUMNS, EXTRA_CELLS, PARSE_ERROR],
    )


def _ragged_batches(lines: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows whose cell count differs from the first line: pad or cut, never drop."""
    size = len(TRADE_FILE_COLUMNS)
    missing = set(MISSING_CELLS)
    for is_wide in (False, True):
        rows = []
        for cells in csv.reader(io.StringIO("\n".join(line.rstrip("\r\n") for line in lines))):
            if cells and (len(cells) > size) == is_wide:
                cells = [None if cell in missing else cell for cell in cells[:size]]
                rows.append(cells + [None] * (size - len(cells)))
        if rows:
            yield _cells_batch(rows, is_wide, None)


def _cells_batch(rows: list[list], is_wide: bool, error: str | None) -> pa.RecordBatch:
    columns = [pa.array(column, pa.string()) for column in zip(*rows)]
    count = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            *columns,
            pa.array([is_wide] * count, pa.bool_()),
            pa.array([error] * count, pa.string()),
        ],
        names=[*TRADE_FILE_COLUMNS, EXTRA_CELLS, PARSE_ERROR],
    )


def read_zipped_csv(
    spark: SparkSession, root: str, batch_dates: list | None = None
) -> DataFrame:
    """Scan ``root`` and parse every landed zip, with its keys and fingerprint."""
    return parse_zipped_csv(with_fingerprint(landed_files(spark, root, batch_dates)))


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(PARSE_ERROR).isNull()).drop(PARSE_ERROR)


def unreadable(parsed: DataFrame) -> DataFrame:
    """One row per bad file, without the trade cells."""
    return parsed.filter(F.col(PARSE_ERROR).isNotNull()).drop(EXTRA_CELLS, *TRADE_FILE_COLUMNS)
