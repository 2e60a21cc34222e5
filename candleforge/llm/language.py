"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the ``PROFILE`` most frequent n-grams of one to three characters, in words of
letters padded with a space. A document's own ``DOCUMENT`` most frequent n-grams are compared with
each language's profile: every n-gram adds how far its rank is out of place there, and one that
is missing adds the most. The nearest profile wins; the score is how much nearer it is than the
runner-up's distance, scaled to 0 to 1.

Profiles come from at most ``PER_LANGUAGE`` documents of each language, counted over their whole texts
on the executors; more than ``LANGUAGES`` labels are refused, as every task holds all profiles. Texts
without letters, and null texts, are ``und`` with score 0; so is every
text when there is no labelled document. Ties go to the language first in the alphabet, ranks of
equally frequent n-grams to the smaller code points. Rows with one doc_id are judged one by one;
extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleforge.llm.common import bounded_sample, slices

PROFILE = 400
DOCUMENT = 300
PER_LANGUAGE = 4_000
#: Labels that may be learned: at this many, the ranks of all profiles take some 1 GB a task.
LANGUAGES = 1_000
UNKNOWN = "und"

_SHIFT = 21  # a code point fits this many bits
_BLOCK = 1 << 20  # characters whose n-grams are counted at a time


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its own value if it is a letter or a mark on one, else a space."""
    return np.array(
        [c if unicodedata.category(chr(c))[0] in "LM" else 32 for c in range(0x110000)], np.uint32
    )


@functools.cache
def _is_letter() -> np.ndarray:
    """For each code point whether it is a letter by itself."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, as numbers, and their counts."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    # Marks belong to n-grams, but do not make a text of their own.
    if not _is_letter()[codes].any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.concatenate([[32], _letters()[codes], [32]]).astype(np.uint64)
    # Runs of spaces become one.
    codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
    parts = []
    for at in range(0, len(codes), _BLOCK):
        block = codes[at : at + _BLOCK + 2]
        own = min(_BLOCK, len(block))
        two = (block[:-1] << np.uint64(_SHIFT)) | block[1:]
        three = (two[:-1] << np.uint64(_SHIFT)) | block[2:]
        # N-grams across two words have a space inside; they are not counted.
        inner = block[1:-1] != 32
        singles = block[:own]
        parts.append(
            np.unique(
                np.concatenate([singles[singles != 32], two[:own], three[:own][inner[:own]]]),
                return_counts=True,
            )
        )
    if len(parts) == 1:
        return parts[0]
    numbers, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return numbers, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def ranked(numbers: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams first."""
    if len(counts) > 4 * most:
        # All that can be among the first, ties included.
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        numbers, counts = numbers[counts >= least], counts[counts >= least]
    return numbers[np.lexsort((numbers, -counts))][:most]


def profiles(docs: DataFrame, lang: str = "lang") -> dict[str, np.ndarray]:
    """A profile for each language of the given (training) documents."""
    known = docs.select("doc_id", "text", F.col(lang).cast("string").alias("lang"))
    known = known.filter("lang is not null and text is not null and doc_id is not null")
    names = known.select("lang").distinct().limit(LANGUAGES + 1).count()
    if names > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages; clean the labels first")
    sample = bounded_sample(known, "lang", PER_LANGUAGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[int, int]] = {}
        for batch in slices(batches):
            for text, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                own = sums.setdefault(name, {})
                for number, count in zip(*(x.tolist() for x in grams(text))):
                    own[number] = own.get(number, 0) + count
        for name, own in sums.items():
            columns = {
                "lang": pa.array([name] * len(own), pa.string()),
                "gram": pa.array(list(own), pa.int64()),
                "n": pa.array(list(own.values()), pa.int64()),
            }
            yield pa.record_batch(columns)

    totals = (
        sample.select("text", "lang")
        .mapInArrow(run, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # PROFILE rows for each language; each task passes on no more than its own first ones.
    best = totals.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= PROFILE)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in best.collect():
        found.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {lang: np.array([g for _, g in sorted(own)], np.uint64) for lang, own in found.items()}


class Profiles:
    """All languages' ranks of every n-gram that some profile has."""

    def __init__(self, found: dict[str, np.ndarray]):
        self.names = sorted(found)
        self.grams = np.unique(np.concatenate([found[n] for n in self.names] or [np.empty(0, np.uint64)]))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int16)
        for column, name in enumerate(self.names):
            rows = np.searchsorted(self.grams, found[name])
            self.ranks[rows, column] = np.arange(len(rows))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(*grams(text), DOCUMENT)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        rows = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        rows = np.where(self.grams[rows] == own, rows, len(self.grams))
        ranks = self.ranks[rows].astype(np.int64)
        away = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, PROFILE, away).sum(axis=0)
        best = int(distance.argmin())
        others = np.delete(distance, best)
        rival = int(others.min()) if len(others) else PROFILE * len(own)
        score = 0.5 + 0.5 * (rival - int(distance[best])) / rival if rival else 0.5
        return self.names[best], float(min(1.0, max(0.0, score)))


def identify(docs: DataFrame, found: dict[str, np.ndarray]) -> DataFrame:
    """The columns of ``docs`` but text, and lang_pred and score of each whole text."""
    names = ("lang_pred", "score")
    kept = [f for f in docs.schema if f.name not in ("text", *names)]
    described = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Profiles(found)
        for batch in slices(batches):
            guesses = [own.predict(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            columns.append(pa.array([g[0] for g in guesses], pa.string()))
            columns.append(pa.array([g[1] for g in guesses], pa.float64()))
            yield pa.record_batch(columns, names=[*(f.name for f in kept), *names])

    return docs.mapInArrow(run, f"{described}lang_pred string, score double")
