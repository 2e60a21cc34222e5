"""Landed zip files as a Spark data source: ``spark.read.format("zipped_trades")``.

A task reads a bin of files of bounded size, straight from storage by blocks: no file is ever a
cell of a table, so neither its size nor that of its member is bounded by memory or by an array.
A file is read twice. The first reading hashes its bytes and decodes the member to its end, in
one pass; then its rows are known to be good and are emitted with the hash, or a
single row tells what is wrong. Files are listed once, on the driver, by the same client.

Storage is opened by pyarrow (local, HDFS, S3, GCS). For a store that only Spark can open
``landing.landed_files`` with ``landing.parse_zipped_csv`` gives the same rows.

Options: ``path``; ``batch_dates``, days parted by commas, of which alone folders are listed;
``bin_bytes``, the size of files of a task.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from candleforge.schema import TRADE_FILE_COLUMNS
from candleforge.sources.landing import EXTRA_CELLS, FILE_NAME, PARSE_ERROR, error_batch, member_batches

# Send the reader itself to the tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "zipped_trades"
BIN_BYTES = 128 << 20
READ_BYTES = 1 << 20

_FILE_FIELDS = [
    ("path", T.StringType()),
    ("file_name", T.StringType()),
    ("symbol", T.StringType()),
    ("batch_date", T.DateType()),
    ("length", T.LongType()),
    ("sha256", T.StringType()),
]

SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in TRADE_FILE_COLUMNS]
    + [T.StructField(EXTRA_CELLS, T.BooleanType()), T.StructField(PARSE_ERROR, T.StringType())]
    + [T.StructField(name, kind) for name, kind in _FILE_FIELDS]
)

_ARROW = {
    "path": pa.string(), "file_name": pa.string(), "symbol": pa.string(),
    "batch_date": pa.date32(), "length": pa.int64(), "sha256": pa.string(),
}


@dataclass
class Bin(InputPartition):
    """Files that one task reads: (path, length)."""

    files: list[tuple[str, int]]

    def __init__(self, files: list[tuple[str, int]]):
        self.files = files
        super().__init__(tuple(path for path, _ in files))


def keys_of(path: str) -> tuple[str, str | None, dt.date | None]:
    """File name, symbol and day; from ``symbol=X/batch_date=Y/`` folders, or else from the name."""
    name = path.rsplit("/", 1)[-1]
    named = re.match(FILE_NAME, name)
    symbol, day = named.groups() if named else (None, None)
    folders = dict(re.findall(r"(?:^|/)(symbol|batch_date)=([^/]*)(?=/)", path))
    symbol, day = unquote(folders.get("symbol", symbol or "")) or None, folders.get("batch_date", day)
    try:
        return name, symbol, dt.date.fromisoformat(day) if day else None
    except ValueError:
        return name, symbol, None


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path within it, which may have any characters."""
    parts = re.match("([a-z][a-z0-9+.-]*):(?://([^/]*))?(.*)", path)
    if parts is None or parts[1] == "file":
        return fs.LocalFileSystem(), parts[3] if parts else path
    store, base = fs.FileSystem.from_uri(f"{parts[1]}://{parts[2] or ''}/")
    return store, base.rstrip("/") + parts[3]


class HashedFile:
    """A file to seek and read in, which hashes each byte when it is first reached in order."""

    def __init__(self, source: pa.NativeFile):
        self.source, self.digest, self.reached = source, hashlib.sha256(), 0

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        return self.source.seek(offset, whence)

    def tell(self) -> int:
        return self.source.tell()

    def read(self, size: int = -1) -> bytes:
        at = self.source.tell()
        data = self.source.read(None if size is None or size < 0 else size)
        if at <= self.reached < at + len(data):
            self.digest.update(memoryview(data)[self.reached - at :])
            self.reached = at + len(data)
        return data

    def hexdigest(self) -> str:
        """The hash of the whole file; what was not reached yet is read now."""
        self.source.seek(self.reached)
        while self.read(READ_BYTES):
            pass
        return self.digest.hexdigest()


class ZippedTradesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        days = options.get("batch_dates", "")
        self.days = [dt.date.fromisoformat(day.strip()) for day in days.split(",") if day.strip()]
        self.bin_bytes = int(options.get("bin_bytes", BIN_BYTES))

    def _listed(self) -> list[tuple[str, int]]:
        store, root = opened(self.root)
        prefix = self.root[: len(self.root) - len(root)] if self.root.endswith(root) else ""
        tops = [root]
        if self.days:
            folders = store.get_file_info(fs.FileSelector(root))
            symbols = [f.path for f in folders if f.type == fs.FileType.Directory and "symbol=" in f.base_name]
            if symbols:
                tops = [f"{symbol}/batch_date={day}" for symbol in symbols for day in self.days]
        found = []
        for top in tops:
            for info in store.get_file_info(fs.FileSelector(top, allow_not_found=True, recursive=True)):
                if info.type == fs.FileType.File and info.base_name.endswith(".zip"):
                    if not self.days or keys_of(info.path)[2] in self.days:
                        found.append((f"{prefix}{info.path}", info.size))
        return sorted(found)

    def partitions(self) -> list[Bin]:
        bins: list[list[tuple[str, int]]] = []
        held = 0
        for path, size in self._listed():
            if not bins or held + size > self.bin_bytes:
                bins.append([])
                held = 0
            bins[-1].append((path, size))
            held += size
        # Spark asks for at least one partition.
        return [Bin(files) for files in bins] or [Bin([])]

    def read(self, partition: Bin) -> Iterator[pa.RecordBatch]:
        for path, length in partition.files:
            yield from file_rows(path, length)


def file_rows(path: str, length: int) -> Iterator[pa.RecordBatch]:
    """The rows of one file with its keys and hash, or one row with what is wrong with it."""
    store, inner = opened(path)
    name, symbol, day = keys_of(path)
    with store.open_input_file(inner) as source:
        hashed, error = HashedFile(source), None
        try:
            for _ in member_batches(hashed):
                pass
        except Exception as failure:  # whatever is wrong with a file, it must not stop the others
            error = f"{type(failure).__name__}: {failure}"
        own = (path, name, symbol, day, length, hashed.hexdigest())
        if error is not None:
            batches = iter([error_batch(error)])
        else:
            source.seek(0)
            batches = member_batches(source)
        for cells in batches:
            kept = [pa.repeat(pa.scalar(v, kind), cells.num_rows) for v, kind in zip(own, _ARROW.values())]
            yield pa.RecordBatch.from_arrays([*cells.columns, *kept], names=[*cells.schema.names, *_ARROW])


class ZippedTrades(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> ZippedTradesReader:
        return ZippedTradesReader(self.options)


def read(
    spark: SparkSession, root: str, batch_dates: list[dt.date] | None = None, bin_bytes: int = BIN_BYTES
) -> DataFrame:
    """The rows of all zip files below ``root``, one task for each bin of files."""
    spark.dataSource.register(ZippedTrades)
    reader = spark.read.format(FORMAT).option("bin_bytes", bin_bytes)
    if batch_dates is not None:
        reader = reader.option("batch_dates", ",".join(map(str, batch_dates)))
    return reader.load(root)
