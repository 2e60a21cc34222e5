"""Quality rules: fixed limits, and an isolation forest on rule statistics.

Each text gives counts (words, symbols, repeated lines and word windows, and kinds of characters).
The forest is grown on the shares derived from them: every tree splits a small random subset of
labelled good documents at random values of random statistics, so a document that is alone in
some statistic ends on a short path. The mean path length over all trees gives a score between 0
and 1, and the threshold above which a document is rejected is calibrated on all labelled rows:
it has the best balance of bad documents caught and good ones lost, a lost share counting
``LOSS_WEIGHT`` times.

Statistics in which labelled bad documents lie no further from the usual than good ones are left
out of the forest: rare values there are no fault. The forest is fitted on at most ``FITTED``
documents of either label; statistics, scores and calibration cover all
rows. Null texts count as empty and fail the limits. Rows with one doc_id are judged one by one;
contradicting labels of a document count as bad. Without labelled rows of both kinds only the
limits decide. Extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import bounded_sample, slices, stored

LEAST_WORDS, MOST_REPEATED = 50, 50
#: Documents of each label the forest is fitted on, at most.
FITTED = 20_000
#: How often a bad document must lie further out than a good one for a statistic to be used.
LEAST_AUC = 0.6
TREES, SUBSET = 128, 256
#: What losing a share of the good documents costs, when catching that share of the bad is 1.
LOSS_WEIGHT = 4.0
_BINS = 2000
_SEED = 17

_SYMBOLS = list(b"#*$%&|<>")
_SPACES = [9, 10, 11, 12, 13, 32]

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_bytes",
]


def counts(text: str | None) -> list[int]:
    """The statistics of one whole text, in the order of ``COUNTS``."""
    octets = (text or "").encode()
    kinds = np.bincount(np.frombuffer(octets, np.uint8), minlength=256)
    words = octets.split()
    spaces, follow = int(kinds[_SPACES].sum()), int(kinds[0x80:0xC0].sum())
    symbols = int(kinds[_SYMBOLS].sum())
    upper, digits = int(kinds[65:91].sum()), int(kinds[48:58].sum())
    letters = upper + int(kinds[97:123].sum())
    marks = int(kinds[:128].sum()) - letters - digits - spaces
    lines = [line for line in octets.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > 3:
        windows = Counter(zip(words, words[1:], words[2:]))
        if len(windows) < len(words) - 2:
            again = np.array([windows[w] > 1 for w in zip(words, words[1:], words[2:])])
            inside = np.zeros(len(words), bool)
            for shift in range(3):
                inside[shift : len(words) - 2 + shift] |= again
            repeated = int(inside.sum())
    return [
        len(words), len(octets) - follow - spaces, symbols, len(lines) - len(set(lines)), repeated,
        len(lines), upper, digits, marks, len(octets),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [counts(t) for t in batch.column("text").to_pylist()]
            table = np.array(rows, np.int64).reshape(-1, len(COUNTS))
            columns = [pa.array(table[:, n]) for n in range(len(COUNTS))]
            yield pa.record_batch([batch.column("doc_id"), *columns], names=["doc_id", *COUNTS])

    fields = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {fields}")


def failed_base():
    """The fixed limits, as a column."""
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def shares(table: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits on: shares and means, so that length itself does not matter."""
    words, chars = np.maximum(table["n_words"], 1), np.maximum(table["word_chars"], 1)
    return np.column_stack(
        [
            table["n_symbols"] / chars,
            table["word_chars"] / words,
            table["n_dup_lines"] / np.maximum(table["n_lines"], 1),
            table["n_repeat_words"] / words,
            table["n_upper"] / chars,
            table["n_digits"] / chars,
            table["n_marks"] / chars,
        ]
    )


def _mean_path(count: np.ndarray | float):
    """Mean path length of an unsuccessful search among ``count`` points."""
    count = np.asarray(count, float)
    harmonic = np.log(np.maximum(count - 1, 1)) + 0.5772156649
    return np.where(count > 2, 2 * harmonic - 2 * (count - 1) / np.maximum(count, 1), count == 2)


def telling(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The statistics in which bad rows lie further from the good rows' median, by rank."""
    if not len(bad):
        return np.arange(good.shape[1])
    middle = np.median(good, axis=0)
    used = []
    for n in range(good.shape[1]):
        far = np.sort(np.abs(good[:, n] - middle[n]))
        own = np.abs(bad[:, n] - middle[n])
        below, upto = np.searchsorted(far, own), np.searchsorted(far, own, "right")
        if (below + upto).mean() / (2 * len(far)) >= LEAST_AUC:
            used.append(n)
    return np.array(used, np.int64) if used else np.arange(good.shape[1])


class Forest:
    """Random trees as arrays: split statistic (-1: leaf), split value, children, path length."""

    def __init__(
        self, points: np.ndarray, used: np.ndarray, trees: int = TREES, subset: int = SUBSET
    ):
        self.used = used
        points = points[:, used]
        rng = np.random.default_rng(_SEED)
        self.subset = min(subset, len(points))
        depth = math.ceil(math.log2(max(self.subset, 2)))
        self.trees = []
        for _ in range(trees):
            chosen = points[rng.choice(len(points), self.subset, replace=False)]
            nodes: list[list[float]] = []
            self._grow(chosen, depth, 0, nodes, rng)
            self.trees.append(np.array(nodes))

    def _grow(self, points, left: int, path: int, nodes: list, rng) -> int:
        at = len(nodes)
        nodes.append([-1, 0, 0, 0, path + float(_mean_path(len(points)))])
        low, high = points.min(axis=0), points.max(axis=0)
        usable = np.flatnonzero(high > low)
        if left and len(points) > 1 and len(usable):
            which = rng.choice(usable)
            value = rng.uniform(low[which], high[which])
            below = points[:, which] < value
            nodes[at][:2] = which, value
            nodes[at][2] = self._child(points[below], left, path, nodes, rng)
            nodes[at][3] = self._child(points[~below], left, path, nodes, rng)
        return at

    def _child(self, points, left, path, nodes, rng) -> int:
        if len(points):
            return self._grow(points, left - 1, path + 1, nodes, rng)
        nodes.append([-1, 0, 0, 0, path + 1])
        return len(nodes) - 1

    def scores(self, points: np.ndarray) -> np.ndarray:
        """Higher means alone: 2 ** -(mean path / expected path)."""
        points = points[:, self.used]
        paths = np.zeros(len(points))
        rows = np.arange(len(points))
        for nodes in self.trees:
            at = np.zeros(len(points), np.int64)
            # Values outside all that the tree has seen leave by the outer side of a split.
            while True:
                which = nodes[at, 0].astype(np.int64)
                inner = which >= 0
                if not inner.any():
                    break
                below = points[rows, np.maximum(which, 0)] < nodes[at, 1]
                at = np.where(inner, nodes[at, np.where(below, 2, 3)].astype(np.int64), at)
            paths += nodes[at, 4]
        expected = max(float(_mean_path(self.subset)), 1e-9)
        return 2 ** (-paths / len(self.trees) / expected)


def scored(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with anomaly: the forest's score, 0 without a forest."""
    if forest is None:
        return stats.withColumn("anomaly", F.lit(0.0))
    described = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = {c: batch.column(c).to_numpy() for c in COUNTS}
            yield batch.append_column("anomaly", pa.array(forest.scores(shares(table))))

    return stats.mapInArrow(run, f"{described}, anomaly double")


def fit(stats: DataFrame, labels: DataFrame) -> tuple[Forest | None, float]:
    """The forest and the threshold, from labels (doc_id, quality 0 or 1) of documents."""
    marked = labels.filter("quality in (0, 1) and doc_id is not null")
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = bounded_sample(marked, "quality", FITTED)
    usable = stats.filter(~failed_base())
    # A doc_id on many rows counts once, by one of its rows that does not depend on their order.
    row = F.struct(F.xxhash64(*COUNTS).alias("mark"), *COUNTS)
    found = usable.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality")
    table = found.agg(F.min(row).alias("one")).select("quality", *(f"one.{c}" for c in COUNTS)).toArrow()
    points = shares({c: table.column(c).to_numpy() for c in COUNTS})
    # In a fixed order, so that the same rows always give the same forest.
    order = np.lexsort(points.T)
    points, good = points[order], table.column("quality").to_numpy()[order] == 1
    if good.sum() < 2:
        return None, 1.0
    forest = Forest(points[good], telling(points[good], points[~good]))
    bins = (
        scored(usable, forest)
        .join(marked, "doc_id")
        .groupBy(F.floor(F.col("anomaly") * _BINS).alias("bin"), "quality")
        .count()
        .collect()
    )  # two rows for each bin at most
    good_at, bad_at = np.zeros(_BINS + 2), np.zeros(_BINS + 2)
    for row in bins:
        (good_at if row["quality"] == 1 else bad_at)[row["bin"]] += row["count"]
    if not good_at.sum() or not bad_at.sum():
        return forest, 1.0
    lost = good_at[::-1].cumsum()[::-1] / good_at.sum()  # share of good rows at or above a bin
    caught = bad_at[::-1].cumsum()[::-1] / bad_at.sum()
    worth = caught - LOSS_WEIGHT * lost
    return forest, int(np.flatnonzero(worth == worth.max())[-1]) / _BINS


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, all counts, anomaly, base_failed and kept."""
    stats = stored(statistics(docs), "rule-statistics")
    forest, threshold = fit(stats, labels)
    base = failed_base()
    return scored(stats, forest).select(
        "*", base.alias("base_failed"), (~base & (F.col("anomaly") < threshold)).alias("kept")
    )
