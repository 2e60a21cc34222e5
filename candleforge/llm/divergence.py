"""Source divergence audit: how the word frequencies of each source of a language differ.

Frequencies are built by single-pass in-memory indexing. A task collects block postings, (language,
source, term) with documents and occurrences, until ``BLOCK`` postings are held; then it spills
them as a run sorted by term. Runs are dealt to hash shards of (language, term). A shard merges
the runs by a heap into one stream by term, in which a term's documents over all sources are next to
each other, so terms in too few documents of their language end there. A shard holds at most ``HELD``
postings of runs; beyond that it merges what it holds into one run, which is as long as its distinct
postings, and goes on.

A term's share in a group is p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), with V terms of the
language and N the group's occurrences of them. Two sources differ by the sum of |p - q| over all V
terms. Where both counts are zero that is the constant |p0 - q0|, so the sum is V * |p0 - q0| plus a
correction from each term that one of the two has. Terms are streamed, and each task adds up
corrections by pair of sources before they are shuffled; it holds at most ``PAIRS`` sums at a time, for
one block of left sources. Sources are few beside documents: the result has a row for
every pair of them, so the list of groups is the root of its size.

Null text, lang and source are ''. Texts without letters have no terms, but their groups occur and are
compared. Repeated rows count each time. A very long text is one unit of a block. An empty table gives
an empty result; columns beyond text, lang and source do not matter, and doc_id is not read.
"""

from __future__ import annotations

import heapq
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleforge.llm.common import slices, stored

#: Documents of its language a term must be in, ranks of terms shown, added occurrences, unit of shares.
LEAST_DOCUMENTS = 30
RANKS = 50
ADDED = 5
UNIT = 1_000_000_000

BLOCK = 500_000  # postings a task collects before it spills them as a run
HELD = 500_000  # postings of runs a shard holds before it merges them
PAIRS = 1 << 20  # sums by pair of sources a task holds

# ``key`` is the language, a zero and the term: terms have no zero, so keys sort and part well.
_POSTING = "key binary, source string, docs long, n long, run long"
_FREQUENCY = "lang string, term binary, source string, n long, term_n long, first int"
_ROWS = 20_000
_PART = b"\0"

# Bytes of terms, with A-Z lower-cased; all other ASCII parts them (fixed values).
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def postings(batch: pa.RecordBatch) -> pa.Table:
    """key, source, docs and n of the texts of a batch."""
    folded = [text.encode().translate(_FOLD) for text in batch.column("text").to_pylist()]
    lists = pc.split_pattern(pa.array(folded, pa.binary()), b" ")
    words, of_text = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(real).dictionary_encode()
    of_text = of_text.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(len(coded.dictionary), 1)
    term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # Each term once a document, with its occurrences there.
    pairs, n = np.unique(of_text * size + term, return_counts=True)
    text, term = np.divmod(pairs, size)
    langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    lang, source = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text] for c in (langs, sources))
    place = (lang * max(len(sources.dictionary), 1) + source) * size + term
    order = np.argsort(place, kind="stable")
    firsts = np.flatnonzero(np.diff(place[order], prepend=-1))
    ends = np.append(firsts[1:], len(order))
    one = order[firsts]
    names = pc.take(langs.dictionary, pa.array(lang[one])).cast(pa.binary())
    key = pc.binary_join_element_wise(names, pc.take(coded.dictionary, pa.array(term[one])), _PART)
    return pa.table(
        {
            "key": key,
            "source": pc.take(sources.dictionary, pa.array(source[one])),
            "docs": pa.array(ends - firsts, pa.int64()),
            "n": pa.array(np.add.reduceat(n[order], firsts) if len(firsts) else [], pa.int64()),
        }
    )


def _one_run(parts: list[pa.Table]) -> pa.Table:
    """Postings of several tables, each (key, source) once, sorted by them."""
    summed = pa.concat_tables(parts).group_by(["key", "source"]).aggregate([("docs", "sum"), ("n", "sum")])
    summed = summed.select(["key", "source", "docs_sum", "n_sum"]).rename_columns(["key", "source", "docs", "n"])
    return summed.sort_by([("key", "ascending"), ("source", "ascending")]).combine_chunks()


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block postings of a task's documents, spilled as sorted runs."""
    from pyspark import TaskContext

    runs = itertools.count(TaskContext.get().partitionId() << 32)
    block: list[pa.Table] = []
    held = 0

    def spilled() -> Iterator[pa.RecordBatch]:
        run = _one_run(block)
        number = pa.repeat(pa.scalar(next(runs), pa.int64()), len(run))
        yield from run.append_column("run", number).to_batches(max_chunksize=_ROWS)

    for batch in slices(batches):
        block.append(postings(batch))
        held += len(block[-1])
        if held >= BLOCK:
            # Postings that several slices share count once before the block is called full.
            block = [_one_run(block)]
            held = len(block[0])
            if 2 * held >= BLOCK:
                yield from spilled()
                block, held = [], 0
    if block:
        yield from spilled()


class _Run:
    """A sorted run, taken from the front."""

    def __init__(self, table: pa.Table):
        self.table, self.keys, self.at = table, table.column("key").combine_chunks(), 0

    def bound(self) -> bytes | None:
        """The key that ends the next portion, None at the end."""
        last = min(self.at + _ROWS, len(self.keys)) - 1
        return self.keys[last].as_py() if self.at < len(self.keys) else None

    def up_to(self, key: bytes) -> pa.Table:
        """All that is left up to a key, that key included."""
        low, high = self.at, len(self.keys)
        while low < high:
            middle = (low + high) // 2
            if self.keys[middle].as_py() <= key:
                low = middle + 1
            else:
                high = middle
        part, self.at = self.table.slice(self.at, low - self.at), low
        return part


def merged(runs: list[_Run]) -> Iterator[pa.Table]:
    """One sorted stream from sorted runs, in portions that never part the postings of a key.

    A heap holds the end of each run's next portion. The least of them bounds what may be merged
    now: no run has anything before it that is not at its front.
    """
    heap = [(bound, number) for number, run in enumerate(runs) if (bound := run.bound()) is not None]
    heapq.heapify(heap)
    while heap:
        key = heap[0][0]
        parts = [part for run in runs if len(part := run.up_to(key))]
        yield _one_run(parts)
        while heap and heap[0][0] <= key:
            _, number = heapq.heappop(heap)
            if (bound := runs[number].bound()) is not None:
                heapq.heappush(heap, (bound, number))


def _merge_shard(least: int):
    """Heap-merge the runs of a shard; terms in fewer than ``least`` documents of their language go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = limit = 0
        whole: list[pa.Table] = []
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD + limit:
                whole = [pa.concat_tables(list(merged(_runs(held, whole))))]
                # What stays is distinct; only as much again makes another merge worth while.
                held, size, limit = [], 0, len(whole[0]) // 2
        for part in merged(_runs(held, whole)):
            yield from _kept(part, least)

    return run


def _runs(held: list[pa.RecordBatch], whole: list[pa.Table]) -> list[_Run]:
    """The rows of a shard by run; they may come in any order and several portions."""
    if not held:
        return [_Run(table) for table in whole]
    rows = pa.Table.from_batches(held)
    rows = rows.sort_by([("run", "ascending"), ("key", "ascending"), ("source", "ascending")]).combine_chunks()
    numbers = rows.column("run").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
    rows = rows.drop_columns(["run"])
    return [_Run(table) for table in [*whole, *(rows.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))]]


def _kept(part: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """The frequencies of the terms of a merged portion that enough documents hold."""
    keys = part.column("key").combine_chunks().dictionary_encode()
    term = keys.indices.to_numpy(zero_copy_only=False)
    docs, n = (part.column(c).to_numpy() for c in ("docs", "n"))
    size = len(keys.dictionary)
    documents = np.zeros(size, np.int64)
    totals = np.zeros(size, np.int64)
    np.add.at(documents, term, docs)
    np.add.at(totals, term, n)
    rows = np.flatnonzero(documents[term] >= least)
    if not len(rows):
        return
    term = term[rows]
    parted = [key.rsplit(_PART, 1) for key in keys.dictionary.take(pa.array(np.unique(term))).to_pylist()]
    at = np.searchsorted(np.unique(term), term)
    langs = pa.array([lang.decode() for lang, _ in parted], pa.string())
    terms = pa.array([name for _, name in parted], pa.binary())
    yield pa.record_batch(
        {
            "lang": langs.take(pa.array(at)),
            "term": terms.take(pa.array(at)),
            "source": part.column("source").combine_chunks().take(pa.array(rows)),
            "n": pa.array(n[rows]),
            "term_n": pa.array(totals[term]),
            # Rows come by key, so the first row of each term differs from the one before.
            "first": pa.array((np.diff(term, prepend=-1) != 0).astype(np.int32)),
        }
    )


def frequencies(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term (UTF-8), source and n, the occurrences of each kept term, above zero.

    ``term_n`` is the term's count in its language, ``first`` is 1 in one row of each term.
    """
    runs = _given(docs, "lang", "source", "text").mapInArrow(_index, _POSTING)
    return runs.repartition("key").mapInArrow(_merge_shard(least), _FREQUENCY)


def _given(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


def _share(count: Column, total: Column, kept: Column) -> Column:
    """p by whole numbers of up to 38 digits."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")
    below = total.cast("decimal(20,0)") + kept.cast("decimal(16,0)") * F.lit(ADDED).cast("decimal(2,0)")
    return F.call_function("div", above, below) + 1


def groups(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """A row for each occurring (lang, source): its total, and the language's total and terms.

    ``least_share`` is the share of a term that the group does not have, 0 without any term.
    """
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counted.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("first").alias("kept"))
    met = _given(docs, "lang", "source").distinct()
    joined = met.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    filled = joined.na.fill(0, ["total", "lang_total", "kept"])
    least = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(0)
    return filled.withColumn("least_share", least)


def _corrections(least: dict[str, tuple[list[str], np.ndarray]], width: dict[str, int]):
    """Sums of corrections by pair of sources, the left one from the row's block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang = block = term = None
        places: dict[str, int] = {}
        waiting: list[np.ndarray] = []
        sums = base = row = None

        def added() -> None:
            shares = np.stack(waiting)
            first = block * width[lang]
            for k in range(len(sums)):
                i = first + k
                apart = np.abs(shares[:, i + 1 :] - shares[:, i : i + 1]).sum(axis=0)
                sums[k, i + 1 :] += apart - len(shares) * np.abs(base[i + 1 :] - base[i])
            waiting.clear()

        def closed() -> Iterator[pa.RecordBatch]:
            if waiting:
                added()
            left, right = np.nonzero(sums)
            names = np.array(least[lang][0], object)
            for at in range(0, len(left), _ROWS):
                i, j = left[at : at + _ROWS], right[at : at + _ROWS]
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang] * len(i), pa.string()),
                        "u": pa.array(names[i + block * width[lang]], pa.string()),
                        "v": pa.array(names[j], pa.string()),
                        "correction": pa.array(sums[i, j], pa.int64()),
                    }
                )

        for batch in batches:
            for new_lang, new_block, new_term, source, share in zip(
                *(batch.column(c).to_pylist() for c in ("lang", "block", "term", "source", "share"))
            ):
                if (new_lang, new_block) != (lang, block):
                    if lang is not None:
                        yield from closed()
                    lang, block, term = new_lang, new_block, None
                    names, base = least[lang]
                    places = {name: n for n, name in enumerate(names)}
                    sums = np.zeros((min(width[lang], len(names) - block * width[lang]), len(names)), np.int64)
                    waiting.clear()
                if new_term != term:
                    if len(waiting) * len(base) >= PAIRS:
                        added()
                    term, row = new_term, base.copy()
                    waiting.append(row)
                row[places[source]] = share
        if lang is not None:
            yield from closed()

    return run


def pair_values(counted: DataFrame, grouped: DataFrame) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a language."""
    # The result has a row for each pair of these, so they are few beside it.
    listed: dict[str, list[tuple[str, int]]] = defaultdict(list)
    for r in grouped.select("lang", "source", "least_share").collect():
        listed[r["lang"]].append((r["source"], r["least_share"]))
    least = {
        lang: ([s for s, _ in found], np.array([p for _, p in found], np.int64))
        for lang, found in ((lang, sorted(found)) for lang, found in listed.items())
    }
    width = {lang: max(1, PAIRS // len(names)) for lang, (names, _) in least.items()}

    size = F.count("*").over(Window.partitionBy("lang"))
    blocked = grouped.withColumn("blocks", F.ceil(size / F.greatest(F.lit(1), F.floor(F.lit(PAIRS) / size))))
    share = _share(F.col("n"), F.col("total"), F.col("kept")).alias("share")
    rows = counted.join(blocked, ["lang", "source"]).select(
        "lang", "term", "source", share,
        F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block"),
    )
    dealt = rows.repartition("lang", "block", "term").sortWithinPartitions("lang", "block", "term")
    parts = dealt.mapInArrow(_corrections(least, width), "lang string, u string, v string, correction long")
    sums = parts.groupBy("lang", "u", "v").agg(F.sum("correction").alias("correction"))

    one = grouped.select("lang", F.col("source").alias("u"), F.col("least_share").alias("p"), "kept")
    other = grouped.select("lang", F.col("source").alias("v"), F.col("least_share").alias("q"))
    pairs = one.join(other, "lang").filter("u < v").join(sums, ["lang", "u", "v"], "left")
    value = F.col("kept") * F.abs(F.col("p") - F.col("q")) + F.coalesce("correction", F.lit(0))
    sides = F.array(F.struct(F.col("u").alias("source"), F.col("v").alias("item")),
                    F.struct(F.col("v").alias("source"), F.col("u").alias("item")))
    return pairs.select("lang", value.cast("long").alias("value"), F.inline(sides)).select(
        "lang", "source", "item", "value"
    )


def term_values(counted: DataFrame, grouped: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms that a source has more often than its language."""
    shares = counted.join(grouped, ["lang", "source"]).select(
        "lang", "source", F.decode("term", "UTF-8").alias("item"),
        (_share(F.col("n"), F.col("total"), F.col("kept"))
         - _share(F.col("term_n"), F.col("lang_total"), F.col("kept"))).alias("value"),
    )
    return shares.filter("value > 0")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources, and the terms that stand out."""
    counted = stored(frequencies(docs, least), "frequencies")
    grouped = stored(groups(docs, counted), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    place = F.row_number().over(order)
    pairs = pair_values(counted, grouped).withColumn("rank", place)
    terms_shown = term_values(counted, grouped).withColumn("rank", place).filter(F.col("rank") <= ranks)
    columns = ("item", "value", "rank")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), *columns).unionByName(
        terms_shown.select("lang", "source", F.lit("term").alias("part"), *columns)
    )


