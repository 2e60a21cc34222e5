"""Benchmark decontamination with suffix arrays over the training documents.

Documents are read in shards of bounded size. A shard's words become one sequence of numbers with a
separator after each document, and its suffix array orders all places by the words that follow, to
the depth of a window. Every distinct window of the benchmark is then searched by bisection, word
after word, which gives all its places. The longest verbatim matches lie within the words so hit:
these and the benchmark's own words in matched windows are ordered together, and the longest match
of a place is that with the benchmark place next before or after it. What is held grows with the
words of the shard and of the benchmark, not with their pairs. A document longer than a shard is
read in parts that overlap by the longest benchmark item.

A window is ``WINDOW`` consecutive words of an item; an item of fewer, but not none, is one window.
A document is contaminated when at least one in ``SHARE`` of its words lies in a matched window.

The benchmark goes to the tasks in blocks of at most about ``BLOCK_BYTES`` of text, which a worker
builds once and holds at some 30 times their size; a larger one
takes one pass over the documents for each block, which carries the words hit so far. Null texts
have no words. Rows with one doc_id are judged one by one; items with one item_id count once.
Columns other than text stay as they are; empty tables are fine on either side.
"""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import slices, stored

WINDOW = 13
SHARE = 20
BLOCK_BYTES = 4 << 20
#: Words of a shard.
SHARD_WORDS = 1 << 19

# A-Z become lower case; all that is neither a digit, a letter nor above ASCII separates words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_SEPARATOR = 0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of the ``depth`` numbers that follow; the end of the sequence is least.

    Prefix doubling: ranks by 2 numbers give those by 4, 8 and so on; only places that still
    share a rank are sorted again. A rank is the slot of the first place of its group.
    """
    count = len(ids)
    pair = ids.astype(np.int64) * (int(ids.max(initial=0)) + 2)
    pair[:-1] += ids[1:] + 1
    order = np.argsort(pair)
    pair = pair[order]
    heads = np.flatnonzero(np.diff(pair, prepend=-1))
    rank = np.empty(count, np.int64)
    rank[order] = np.repeat(heads, np.diff(heads, append=count))
    known = 2
    while known < depth:
        head = rank[order]
        same = head[1:] == head[:-1]
        open_ = np.zeros(count, bool)
        open_[1:] |= same
        open_[:-1] |= same
        slots = np.flatnonzero(open_)
        if not len(slots):
            break
        places = order[slots]
        after = places + known
        inside = after < count
        second = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        key = head[slots] * (count + 1) + second
        resort = np.argsort(key, kind="stable")
        key, places = key[resort], places[resort]
        order[slots] = places
        firsts = np.flatnonzero(np.diff(key, prepend=-1))
        rank[places] = np.repeat(slots[firsts], np.diff(firsts, append=len(key)))
        known *= 2
    return order


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for each pair of numbers from 0, in order of the pairs."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


class Benchmark:
    """A block of benchmark items, as words and as the list of its distinct windows."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.window = window
        self.names = [name for name, _ in items]
        texts = [words_of(text) for _, text in items]
        self.vocabulary: dict[bytes, int] = {}
        flat = [self.vocabulary.setdefault(w, len(self.vocabulary)) for t in texts for w in t]
        self.flat = np.array(flat, np.int64)
        size = np.array([len(t) for t in texts], np.int64)
        self.item = np.repeat(np.arange(len(texts)), size)
        begin = np.cumsum(size) - size
        self.depth = int(max(size, default=0))
        place = np.arange(len(flat))
        left = (begin + size)[self.item] - place  # words of each suffix
        whole = (size[self.item] < window) & (place == begin[self.item])
        # Where windows begin, in order of their words; equal ones are searched once.
        place = place[whole | (left >= window)]
        words = np.minimum(left[place], window)
        same = words
        for depth in range(min(window, self.depth)):
            inside = np.minimum(place + depth, len(flat) - 1)
            same = _pairs(same, np.where(depth < words, self.flat[inside] + 1, 0))
        order = np.argsort(same, kind="stable")
        self.places, same = place[order], same[order]
        self.bounds = np.append(np.flatnonzero(np.diff(same, prepend=-1)), len(same))
        self.first = self.places[self.bounds[:-1]]
        self.words = words[order][self.bounds[:-1]]


class Matches:
    """What one shard's search found: for each matched window its number and slots [low, high)."""

    def __init__(self, windows: np.ndarray, low: np.ndarray, high: np.ndarray):
        order = np.argsort(windows)
        self.windows, self.low, self.high = windows[order], low[order], high[order]


def search(ids: np.ndarray, order: np.ndarray, number: dict[bytes, int], bench: Benchmark) -> Matches:
    """Bisect every window of the benchmark into the suffix array, one more word at a time."""
    live = np.arange(len(bench.first))
    low = np.zeros(len(live), np.int64)
    high = np.full(len(live), len(ids), np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    lookup = np.array([number.get(w, -2) for w in bench.vocabulary], np.int64)
    most = int(bench.words.max(initial=0))
    padded = np.append(ids, np.full(most + 1, -1, ids.dtype))
    for depth in range(most):
        word = lookup[bench.flat[bench.first[live] + depth]]
        low, high = _bound(padded, order, depth, word, low, high)
        full = (high > low) & (bench.words[live] == depth + 1)
        done.append((live[full], low[full], high[full]))
        go = (high > low) & ~full
        live, low, high = live[go], low[go], high[go]
        if not len(live):
            break
    none = np.empty(0, np.int64)
    return Matches(*(np.concatenate([none, *(d[n] for d in done)]) for n in range(3)))


def _bound(padded, order, depth, word, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Within slots [low, high), those whose word at ``depth`` is ``word``."""
    bounds = []
    for side in (0, 1):
        a, b = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(a < b)):
            middle = (a[open_] + b[open_]) >> 1
            here = padded[order[middle] + depth]
            right = here <= word[open_] if side else here < word[open_]
            a[open_[right]] = middle[right] + 1
            b[open_[~right]] = middle[~right]
        bounds.append(a)
    return bounds[0], bounds[1]


def _expand(order, low, high) -> tuple[np.ndarray, np.ndarray]:
    """All places of the slots [low, high), and which interval each is from."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    slots = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
    return order[slots], owner


def _longest(
    ids: np.ndarray, hit: np.ndarray, starts: np.ndarray, own: np.ndarray, bench: Benchmark,
    wanted: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """For places ``starts`` of matched windows, the words of their longest match and its item.

    ``own`` are the benchmark's words in matched windows, ascending; ``wanted`` is the benchmark in
    the shard's numbers. Both sides become one sequence, each run with an end of its own, so that
    no match goes beyond a run. Doubling numbers equal stretches of 1, 2, 4 and more words.
    """
    there = np.flatnonzero(hit)
    cut_there = np.flatnonzero(np.diff(there) > 1) + 1
    cut_own = np.flatnonzero((np.diff(own) > 1) | (np.diff(bench.item[own]) != 0)) + 1
    runs = np.concatenate([cut_there, [len(there)], len(there) + cut_own, [len(there) + len(own)]])
    words = np.concatenate([ids[there], wanted[own]])
    ends = int(words.max()) + 1 + np.arange(len(runs))
    # Where each word goes, with an end after each run.
    slot = np.arange(len(words)) + np.searchsorted(runs, np.arange(len(words)), "right")
    level = np.empty(len(words) + len(runs), np.int64)
    level[slot] = words
    level[runs + np.arange(len(runs))] = ends
    longest = int(np.diff(runs, prepend=0).max())
    count, step = len(level), 1
    level = np.unique(level, return_inverse=True)[1]
    levels = [level.astype(np.int32)]
    while step <= longest and int(level.max()) + 1 < count:
        after = np.zeros(count, np.int64)
        after[:-step] = level[step:] + 1
        level = _pairs(level, after)
        levels.append(level.astype(np.int32))
        step *= 2
    order = np.argsort(level, kind="stable")
    ours = np.zeros(count, bool)
    ours[slot[len(there) :]] = True
    sorted_ours = ours[order]
    at = np.arange(count)
    before = np.maximum.accumulate(np.where(sorted_ours, at, -1))
    behind = np.minimum.accumulate(np.where(sorted_ours, at, count)[::-1])[::-1]
    rank = np.empty(count, np.int64)
    rank[order] = at
    places = slot[np.searchsorted(there, starts)]
    item = np.zeros(count, np.int64)
    item[slot[len(there) :]] = bench.item[own]
    best, whose = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    for near in (before, behind):
        beside = near[rank[places]]
        real = (beside >= 0) & (beside < count)
        beside = order[np.where(real, beside, 0)]
        size = np.zeros(len(places), np.int64)
        for power in range(len(levels) - 1, -1, -1):
            a, b = places + size, beside + size
            inside = real & (a < count) & (b < count)
            equal = inside.copy()
            equal[inside] = levels[power][a[inside]] == levels[power][b[inside]]
            size[equal] += 1 << power
        more = size > best
        best[more], whose[more] = size[more], item[beside[more]]
    return best, whose


class _Row:
    """What is known of a document: hit words, items, its longest match."""

    def __init__(self, words: int, hits: bytes | None, items: list | None, longest: tuple):
        self.hit = np.zeros(words, bool)
        if hits:
            packed = np.frombuffer(hits, np.uint8)
            self.hit = np.unpackbits(packed, count=words).astype(bool)
        self.items = set(items or ())
        self.longest = longest


def _shards(texts: list[list[bytes]], depth: int) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """Parts (row, first word, words) of documents, together about ``SHARD_WORDS`` words."""
    shard, size = [], 0
    for row, words in enumerate(texts):
        for first in range(0, max(len(words), 1), SHARD_WORDS):
            part = words[first : first + SHARD_WORDS + depth]
            if shard and size + len(part) > SHARD_WORDS:
                yield shard
                shard, size = [], 0
            shard.append((row, first, part))
            size += len(part)
            if first + len(part) >= len(words):
                break
    if shard:
        yield shard


def _scan(texts: list[list[bytes]], rows: list[_Row], bench: Benchmark) -> None:
    for shard in _shards(texts, bench.depth):
        # Numbers in order of first occurrence; 0 is kept for the separator.
        number: dict[bytes, int] = defaultdict(itertools.count(1).__next__)
        sizes = np.array([len(part) + 1 for _, _, part in shard])
        begins = np.cumsum(sizes) - sizes
        ids = np.full(sizes.sum(), _SEPARATOR, np.int64)
        for begin, (_, _, part) in zip(begins.tolist(), shard):
            ids[begin : begin + len(part)] = [number[w] for w in part]
        order = suffix_array(ids, int(bench.words.max(initial=0)))
        found = search(ids, order, number, bench)
        if not len(found.windows):
            continue
        places, which = _expand(order, found.low, found.high)
        sizes_ = bench.words[found.windows][which]
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, places, 1)
        np.add.at(edge, places + sizes_, -1)
        hit = np.cumsum(edge)[:-1] > 0
        owner = np.searchsorted(begins, places, "right") - 1
        for part in np.unique(owner).tolist():
            row, first, words = shard[part]
            begin = begins[part]
            rows[row].hit[first : first + len(words)] |= hit[begin : begin + len(words)]
        held, size = bench.bounds[found.windows], np.diff(bench.bounds)[found.windows]
        # The items of a window once for each document that has it.
        pairs = np.unique(which * len(shard) + owner)
        shown = -1
        for at, part in zip((pairs // len(shard)).tolist(), (pairs % len(shard)).tolist()):
            if at != shown:
                members = bench.item[bench.places[held[at] : held[at] + size[at]]]
                names, shown = {bench.names[n] for n in np.unique(members).tolist()} - {None}, at
            rows[shard[part][0]].items |= names
        # Windows of short items are whole matches; places are by length, then by place.
        length, item = sizes_.copy(), bench.item[bench.places[held]][which]
        wide = sizes_ == bench.window
        if wide.any():
            covered = np.zeros(len(bench.flat) + 1, np.int64)
            own = found.windows[bench.words[found.windows] == bench.window]
            begun, _ = _expand(bench.places, bench.bounds[own], bench.bounds[own + 1])
            np.add.at(covered, begun, 1)
            np.add.at(covered, begun + bench.window, -1)
            own = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
            wanted = np.array([number.get(w, -2) for w in bench.vocabulary], np.int64)[bench.flat]
            length[wide], item[wide] = _longest(ids, hit, places[wide], own, bench, wanted)
        by = np.lexsort((places, -length, owner))
        parts, at = np.unique(owner[by], return_index=True)
        for part, n in zip(parts.tolist(), by[at].tolist()):
            row, first, _ = shard[part]
            if length[n] > rows[row].longest[0]:
                place = first + int(places[n] - begins[part])
                rows[row].longest = (int(length[n]), place, bench.names[item[n]])


_FIELDS = [
    ("n_words", "long", pa.int64()),
    ("n_hit", "long", pa.int64()),
    ("items", "array<string>", pa.list_(pa.string())),
    ("longest_words", "long", pa.int64()),
    ("longest_at", "long", pa.int64()),
    ("longest_item", "string", pa.string()),
    ("contaminated", "boolean", pa.bool_()),
]
_HITS = ("__hits", "binary", pa.binary())


_BUILT: dict[str, Benchmark] = {}


def _built(key: str, items: Broadcast, window: int) -> Benchmark:
    """The benchmark of a pass; a worker builds it once for all its tasks."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Benchmark(items.value, window)
    return _BUILT[key]


def _pass(docs: DataFrame, items: list, window: int, with_text: bool, carry: bool) -> DataFrame:
    own = {n for n, _, _ in _FIELDS} | {_HITS[0]}
    kept = [f for f in docs.schema if f.name not in own and (with_text or f.name != "text")]
    fields = [*_FIELDS, _HITS] if carry else _FIELDS
    described = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    described += [f"{n} {t}" for n, t, _ in fields]
    # At most a block, which goes to each executor once.
    shared, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = _built(key, shared, window)
        for batch in slices(batches):
            texts = [words_of(t) for t in batch.column("text").to_pylist()]
            if _HITS[0] in batch.schema.names:
                names = (_HITS[0], "items", "longest_words", "longest_at", "longest_item")
                before = zip(*(batch.column(n).to_pylist() for n in names))
                rows = [_Row(len(t), b[0], b[1], b[2:]) for t, b in zip(texts, before)]
            else:
                rows = [_Row(len(t), None, None, (0, None, None)) for t in texts]
            _scan(texts, rows, bench)
            counts = [(len(t), int(r.hit.sum())) for t, r in zip(texts, rows)]
            new = [
                [words for words, _ in counts],
                [hit for _, hit in counts],
                [sorted(r.items) for r in rows],
                *([r.longest[n] for r in rows] for n in range(3)),
                [hit > 0 and SHARE * hit >= words for words, hit in counts],
                [np.packbits(r.hit).tobytes() for r in rows] if carry else None,
            ]
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(x, kind) for x, (_, _, kind) in zip(new, fields)]
            yield pa.record_batch(arrays, names=[f.name for f in kept] + [n for n, _, _ in fields])

    return docs.mapInArrow(run, ", ".join(described))


def _given(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return items.filter("text is not null")


def _count_blocks(benchmark: DataFrame) -> int:
    total = _given(benchmark).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return -(-total // BLOCK_BYTES) or 1


def _block(benchmark: DataFrame, block: int, blocks: int) -> list[tuple[str | None, str]]:
    """One of ``blocks`` parts of the benchmark, about ``BLOCK_BYTES`` of text at most."""
    items = _given(benchmark)
    if blocks > 1:
        items = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
    return [(row[0], row[1]) for row in items.toLocalIterator()]


def overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, with_text: bool = False
) -> DataFrame:
    """The columns of ``docs`` (text on demand) and what the benchmark shares with each text.

    n_words, n_hit (words inside matched windows), items (ids whose windows occur), longest_words,
    longest_at and longest_item (the longest verbatim match of at least a window, by its first
    word), contaminated. Items without an id count in all of these but the ids: they are not among
    items, and longest_item is null where the longest match is theirs.
    """
    blocks = _count_blocks(benchmark)
    for block in range(blocks):
        last = block == blocks - 1
        items = _block(benchmark, block, blocks)
        docs = _pass(docs, items, window, with_text or not last, carry=not last)
        if not last:
            docs = stored(docs, "overlaps")
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, in their own columns."""
    clash = {n for n, _, _ in _FIELDS} & set(docs.columns)
    if clash:
        # Columns named like the findings step aside and come back.
        docs = docs.withColumnsRenamed({c: f"__own_{c}" for c in clash})
    clean = overlaps(docs, benchmark, window, with_text=True).filter(~F.col("contaminated"))
    clean = clean.drop(*[n for n, _, _ in _FIELDS])
    return clean.withColumnsRenamed({f"__own_{c}": c for c in clash})
