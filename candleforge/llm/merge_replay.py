"""Byte-level BPE by replaying merges over a block of words, and decoding.

The distinct words of a block of documents are laid out as one sequence of symbols. An inverted
index maps the rank of each adjacent pair to the places where it occurs. Merges are applied in
rank order over all words at once; each touches only the two neighbouring pairs, whose new ranks
enter the index. Within a word this is the order of the usual algorithm: lowest rank first,
leftmost first.

Null texts are empty and have no ids. Rows are independent, so ties, repeats, further columns and
empty tables need no rule.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from candleforge.llm.common import slices
from candleforge.llm.pieces import Pieces

_NONE = -1
_BITS = 32
_FEW = 100  # fewer items are handled one by one, as arrays would cost more


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


class Replay:
    """Encodes many words at once by the given ranks of byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.joined: dict[tuple[int, int], int] = {}

    def _rank(self, left: int, right: int) -> int:
        """The rank of two symbols' bytes together, or -1."""
        rank = self.joined.get((left, right))
        if rank is None:
            rank = self.ranks.get(self.token[left] + self.token[right], _NONE)
            self.joined[left, right] = rank
        return rank

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs, -1 where a side is missing; each distinct pair is looked up once."""
        if len(left) < _FEW:
            sides = zip(left.tolist(), right.tolist())
            ranks = [self._rank(a, b) if a >= 0 and b >= 0 else _NONE for a, b in sides]
            return np.array(ranks, np.int64)
        out = np.full(len(left), _NONE, np.int64)
        real = np.flatnonzero((left >= 0) & (right >= 0))
        pairs, where = np.unique(left[real] << _BITS | right[real], return_inverse=True)
        low = (1 << _BITS) - 1
        found = [self._rank(p >> _BITS, p & low) for p in pairs.tolist()]
        out[real] = np.array(found, np.int64)[where]
        return out

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(w) for w in words], np.int64)
        count = int(sizes.sum())
        if not count:
            return [np.empty(0, np.int64) for _ in words]
        ends = np.cumsum(sizes)
        # A merged-away place has symbol -1. One place more, so that -1 may be an index.
        symbols = np.full(count + 1, _NONE, np.int64)
        symbols[:count] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, count + 2), np.arange(-1, count)
        after[ends[sizes > 0] - 1] = _NONE
        before[(ends - sizes)[sizes > 0]] = _NONE
        # The rank of the pair that begins at each place, -1 for none.
        pair = np.full(count + 1, _NONE, np.int64)
        places = np.flatnonzero(after[:count] != _NONE)
        pair[places] = self._ranks(symbols[places], symbols[places + 1])

        index: dict[int, list[int]] = {}
        waiting: list[int] = []

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            if len(places) < _FEW:
                groups = zip(ranks.tolist(), ([p] for p in places.tolist()))
            else:
                order = np.argsort(ranks, kind="stable")
                ranks, places = ranks[order], places[order].tolist()
                firsts = np.flatnonzero(np.diff(ranks, prepend=_NONE - 1)).tolist()
                cuts = zip(firsts, [*firsts[1:], len(ranks)])
                groups = ((int(ranks[a]), places[a:b]) for a, b in cuts)
            for rank, own in groups:
                if rank != _NONE:
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(waiting, rank)
                    index[rank].extend(own)

        enter(places, pair[places])
        while waiting:
            rank = heapq.heappop(waiting)
            places = np.array(sorted(index.pop(rank)), np.int64)
            while True:
                # Earlier merges may have changed a place. Of overlapping pairs the leftmost
                # goes first: one whose left neighbour is not a pair of this rank.
                places = places[pair[places] == rank]
                if not len(places):
                    break
                left = before[places]
                heads = places[(left == _NONE) | (pair[left] != rank)]
                new = np.full(len(heads), rank)
                ahead = self._ranks(new, symbols[after[after[heads]]])
                behind = self._ranks(symbols[before[heads]], new)
                lower = ((ahead != _NONE) & (ahead < rank)) | ((behind != _NONE) & (behind < rank))
                if one_each := bool(lower.any()):
                    # A lower rank comes up: each word takes one step, the rest waits for it.
                    _, chosen = np.unique(np.searchsorted(ends, heads, "right"), return_index=True)
                    heads = heads[chosen]
                other = after[heads]
                following = after[other]
                symbols[heads], symbols[other], pair[other] = rank, _NONE, _NONE
                after[heads] = following
                inner = following != _NONE
                before[following[inner]] = heads[inner]
                # Only the pairs on either side change.
                left = before[heads]
                left = left[left != _NONE]
                touched = np.unique(np.concatenate([heads, left]))
                pair[touched] = self._ranks(symbols[touched], symbols[after[touched]])
                enter(touched, pair[touched])
                if one_each:
                    rest = places[pair[places] == rank]
                    enter(rest, pair[rest])
                    break
        whole = symbols[:count]
        kept = np.flatnonzero(whole != _NONE)
        cuts = np.searchsorted(kept, ends)
        return np.split(whole[kept], cuts[:-1])


class Codec:
    """Texts to ids and back by a rank file and a pattern that finds the words."""

    def __init__(self, path: str, pattern: str):
        self.replay = Replay(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.pieces = Pieces(self._encode_pieces, np.dtype("<u4"))
        ranks = range(max(self.replay.token) + 1)
        # By id: its decimal number, and the bytes it stands for.
        self.decimal = pa.array(map(str, ranks), pa.binary())
        self.token = pa.array(map(self.replay.token.get, ranks), pa.binary())

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """For each piece its ids as 32-bit integers."""
        ranks = self.replay.ranks
        find = self.pattern.findall
        words = [[w.encode() for w in find(piece)] for piece in pieces]
        rest = list({w for many in words for w in many if w not in ranks})
        encoded = self.replay.encode(rest)
        ids = {w: found.astype("<u4").tobytes() for w, found in zip(rest, encoded)}
        ids.update((w, array("I", [ranks[w]]).tobytes()) for many in words for w in many if w in ranks)
        return [b"".join([ids[w] for w in many]) for many in words]

    def encode(self, texts: list[str]) -> list[array]:
        """For each text its ids."""
        ids, counts = self.pieces.of(pa.array(texts, pa.string()))
        return [array("I", part.tobytes()) for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []

    def _joined(self, words: pa.Array, ids: np.ndarray, counts: np.ndarray, between: bytes) -> pa.Array:
        """For each text the words of its ids, joined."""
        ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, words.take(pa.array(ids))), between)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each text."""
        return self._joined(self.token, ids, counts, b"")

    def numbers(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The ids of each text as decimal numbers with single spaces."""
        return self._joined(self.decimal, ids, counts, b" ")


def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for all tasks of a worker."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, round_trip: bool = True) -> DataFrame:
    """All columns of ``docs`` and the ids of its texts.

    ``ids`` is an array of ints. With ``round_trip``, ``ids_sha256`` is the digest of the ids as
    decimal numbers and ``decoded_sha256`` that of the bytes that decoding gives; the arrays
    then stay in the task.
    """
    return _encoded(docs, path, pattern, "digests" if round_trip else "ids")


def _encoded(docs: DataFrame, path: str, pattern: str, give: str) -> DataFrame:
    given = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    fields = "n_tokens long, ids array<int>" if give == "ids" else given
    names = [f.split()[0] for f in fields.split(", ")]
    kept = [f for f in docs.schema if f.name not in names]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches):
            columns = [batch.column(f.name) for f in kept]
            ids, counts = own.pieces.of(pc.fill_null(batch.column("text"), ""))
            sizes = pa.array(counts, pa.int64())
            if give == "ids":
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, ids.view(np.int32))
                yield pa.record_batch([*columns, sizes, lists], names=[f.name for f in kept] + names)
                continue
            new = [sizes, _digests(own.numbers(ids, counts)), _digests(own.decode(ids, counts))]
            yield pa.record_batch([*columns, *new], names=[f.name for f in kept] + names)

    return docs.mapInArrow(run, f"{head}, {fields}" if head else fields)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the bytes that the ids stand for; null ids give null."""
    kept = [f for f in rows.schema if f.name != text]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: t for t, rank in read_ranks(path).items()}
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            found = [None if x is None else b"".join([token[i] for i in x]) for x in lists]
            columns = [batch.column(f.name) for f in kept]
            yield pa.record_batch(
                [*columns, pa.array(found, pa.binary())], names=[f.name for f in kept] + [text]
            )

    return rows.mapInArrow(run, f"{fields}, `{text}` binary")
