"""Token ids in Arrow files of equal-length sequences, and reading them back.

The ids of all documents, in ascending order of doc_id, form one stream. It is cut into shards by
ranges of doc_id; each shard is one Arrow file whose record batches hold two fixed-size lists per
row: ``ids`` (unsigned, the narrowest type that holds the vocabulary) and ``mask`` (booleans, true
for a real id, false for padding at the end of the shard; Arrow packs eight to a byte). A list's
place follows from its number, so a mapped file gives any sequence and its mask without copying.
Each file's schema metadata holds the sequence length.

Tasks write under names of their own and report what they wrote as rows; the report of the
attempts that count becomes the manifest, so retried or lost tasks leave only unlisted files. The
manifest has one row per file with the number of ids before it. A second table, the document
index, has each document's place inside its file.

Null texts are empty: they have the end id alone. Rows with one doc_id are ordered by a hash of the
text, rows without an id come first. Extra columns do not matter; an empty table gives no file.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge import session
from candleforge.llm.common import slices, stored
from candleforge.llm.pieces import Pieces

#: Ids of a sequence, and sequences of a record batch.
LENGTH = 2048
BATCH = 64

END_ID = 0


class _Library:
    """The tokenizers library, asked once for every distinct piece."""

    def __init__(self, path: str):
        # One task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.pieces = Pieces(self._encode_pieces, self.kind)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array(self.kind.char, e.ids).tobytes() for e in encoded]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as packed integers."""
        ids, counts = self.pieces.of(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []

    def ended(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each followed by the end id, and how many each has."""
        ids, counts = self.pieces.of(texts)
        counts = counts + 1
        stream = np.full(int(counts.sum()), END_ID, self.kind)
        real = np.ones(len(stream), bool)
        real[np.cumsum(counts) - 1] = False
        stream[real] = ids
        return stream, counts


@functools.lru_cache(maxsize=2)
def _library(path: str) -> _Library:
    return _Library(path)


class _ShardWriter:
    """One Arrow file, fed with ids in any portions."""

    def __init__(self, location: str, kind: np.dtype, length: int):
        self.length, self.kind, self.held, self.total = length, kind, [], 0
        self.size = 0
        self.schema = pa.schema(
            {
                "ids": pa.list_(pa.from_numpy_dtype(kind), length),
                "mask": pa.list_(pa.bool_(), length),
            },
            metadata={"length": str(length)},
        )
        store, path = fs.FileSystem.from_uri(location)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.sink = store.open_output_stream(path)
        self.file = pa.ipc.new_file(self.sink, self.schema)

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        columns = [
            pa.FixedSizeListArray.from_arrays(x, self.length) for x in (pa.array(ids), mask)
        ]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def write(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        full = self.length * BATCH
        if self.size >= full:
            ids = np.concatenate(self.held)
            for at in range(0, len(ids) - full + 1, full):
                self._batch(ids[at : at + full], full)
            rest = len(ids) % full
            self.held, self.size = [ids[len(ids) - rest :]], rest

    def close(self) -> None:
        if self.size:
            ids = np.concatenate(self.held)
            padded = np.zeros(-(-len(ids) // self.length) * self.length, self.kind)
            padded[: len(ids)] = ids
            self._batch(padded, len(ids))
        self.file.close()
        self.sink.close()


class Shard:
    """Random access to a written file: sequence n, its mask, or any range of its ids."""

    def __init__(self, location: str):
        store, path = fs.FileSystem.from_uri(location)
        if isinstance(store, fs.LocalFileSystem):
            self.source = pa.memory_map(path)
        else:
            self.source = store.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = int(self.file.schema.metadata[b"length"])
        self.batch: tuple[int, np.ndarray, pa.BooleanArray] | None = None

    def _load(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if self.batch is None or self.batch[0] != number:
            batch = self.file.get_batch(number)
            ids, mask = (column.flatten() for column in batch.columns)
            self.batch = number, ids.to_numpy(zero_copy_only=True), mask
        return self.batch[1], self.batch[2]

    def sequence(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        ids, mask = self._load(number // BATCH)
        at = number % BATCH * self.length
        return ids[at : at + self.length], mask.slice(at, self.length)

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Real ids from a place in the shard on, batch by batch."""
        full = self.length * BATCH
        while count:
            ids, mask = self._load(start // full)
            part = ids[start % full : start % full + count]
            if mask.slice(start % full, len(part)).true_count < len(part):
                raise ValueError("the index points at padding")
            yield part
            start, count = start + len(part), count - len(part)


_INDEX = [("part", "long"), ("file", "string"), ("first", "long"), ("n_tokens", "long")]


def write(docs: DataFrame, path: str, folder: str, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Write the files under ``folder`` and return the manifest and the document index.

    The manifest has part, file, n_tokens and start, the number of ids in all earlier files; the
    index has doc_id, part, file, first (place in the file) and n_tokens.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    target = f"{folder.rstrip('/')}/shards"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        library = _library(path)
        part = TaskContext.get().partitionId()
        location = f"{target}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        shard = None
        for batch in slices(batches):
            rows = batch.num_rows
            if shard is None and rows:
                shard = _ShardWriter(location, library.kind, length)
            ids, counts = library.ended(pc.fill_null(batch.column("text"), ""))
            firsts = shard.total + np.cumsum(counts) - counts
            shard.write(ids)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": pa.array([part] * rows, pa.int64()),
                    "file": pa.array([location] * rows, pa.string()),
                    "first": pa.array(firsts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                }
            )
        if shard is not None:
            shard.close()

    fields = ", ".join(f"{n} {t}" for n, t in _INDEX)
    index = stored(ordered.mapInArrow(run, f"doc_id {kind}, {fields}"), "token-index")
    # One row per file: the list is as long as the number of tasks.
    sums = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n_tokens"))
    rows, start = [], 0
    for row in sums.orderBy("part").collect():
        rows.append((row["part"], row["file"], row["n_tokens"], start))
        start += row["n_tokens"]
    schema = "part long, file string, n_tokens long, start long"
    manifest = docs.sparkSession.createDataFrame(rows, schema)
    manifest.write.parquet(f"{folder.rstrip('/')}/manifest")
    return docs.sparkSession.read.parquet(f"{folder.rstrip('/')}/manifest"), index


def read_digests(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    The checksum is over the ids as little-endian unsigned 32-bit integers. The index is cut into
    ranges of places in the stream, each read by one task from its file.
    """
    placed = index.join(manifest.select("part", "start"), "part").select(
        "doc_id", "file", "first", "n_tokens", (F.col("start") + F.col("first")).alias("start")
    )
    ordered = placed.repartitionByRange("start").sortWithinPartitions("start")
    kind = index.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            sums = []
            places = zip(*(batch.column(c).to_pylist() for c in ("file", "first", "n_tokens")))
            for file, first, count in places:
                if file != at:
                    at, shard = file, Shard(file)
                value = 0
                for ids in shard.ids(first, count):
                    value = zlib.crc32(ids.astype("<u4"), value)
                sums.append(value)
            yield pa.record_batch(
                {c: batch.column(c) for c in ("doc_id", "start", "n_tokens")}
                | {"ids_crc32": pa.array(sums, pa.int64())}
            )

    return ordered.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and read every document's digest back."""
    folder = session.work_dir(docs.sparkSession, "token-files")
    return read_digests(*write(docs, path, folder if "://" in folder else f"file://{folder}", length))
