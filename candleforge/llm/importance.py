"""Importance resampling towards a target: draw the documents that look most like target texts.

Features are the runs of 1 to ``grams`` consecutive words of a text, repeats included; a feature
belongs to the bucket crc32(its bytes) modulo ``buckets``. With S features in all documents, s of
them in a bucket, and T and t for the target texts, a bucket's gain is
floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))). A document's weight is the
floored mean of its features' gains, its score is the weight plus Gumbel noise that depends on the
seed and doc_id alone; the highest scores among documents with ``least`` words are drawn, ties to the
smaller doc_id. That is a draw without replacement in proportion to exp(weight / 1000).

Texts are cut by Arrow kernels (``ascii_lower``, ``split_pattern_regex``, ``list_flatten``,
``dictionary_encode``). Longer runs are pairs of shifted dictionary indices: each distinct pair is
hashed once, by carrying the checksum of its first part on. Gains reach the features by ``take`` and are
added up by segment. Two map-only passes read the texts; the first reports at most ``buckets`` rows a
task. The cut of the draw comes from counts by score, a whole number of bounded range, so only
the drawn documents (and those tied at the cut) are ordered.

Null and empty texts have no features: weight 0, and never drawn if ``least`` is positive. Rows with one
doc_id are separate; equal rows are ordered by a hash of the text. A null doc_id is noise of the empty
id and comes after all others among ties. A very long text is held with its slice, nothing is cut.
Empty tables give no features, all gains 0 and an empty result. Extra columns do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import slices, stored

BUCKETS = 10_000
GRAMS = 1
LEAST = 20
SEED = 2024

# What parts words (fixed values); other characters belong to them.
_PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SCALE = 1000.0


def feature_buckets(texts: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, the text each belongs to (ascending), and words by text."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), _PARTING)
    parents = pc.list_parent_indices(lists)
    words = pc.list_flatten(lists)
    real = pc.greater(pc.binary_length(words), 0)
    words, parents = words.filter(real), parents.filter(real).to_numpy(zero_copy_only=False)
    counts = np.bincount(parents, minlength=len(texts))
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    plain = [w.encode() for w in coded.dictionary.to_pylist()]
    sums = np.fromiter(map(zlib.crc32, plain), np.uint32, len(plain))
    found, owners = [sums[index] % buckets if len(index) else index], [parents]
    runs, owner, last = index, parents, index
    for _ in range(1, grams):
        # A run of one word more: each run but the last of its text with the word behind it.
        joined = owner[:-1] == owner[1:]
        behind = last[1:][joined]
        pairs, runs = np.unique(runs[:-1][joined] * max(len(plain), 1) + behind, return_inverse=True)
        heads, tails = np.divmod(pairs, max(len(plain), 1))
        carried = zip(heads.tolist(), tails.tolist())
        sums = np.fromiter((zlib.crc32(b" " + plain[t], sums[h]) for h, t in carried), np.uint32, len(pairs))
        owner, last = owner[:-1][joined], behind
        found.append(sums[runs] % buckets if len(runs) else runs)
        owners.append(owner)
    found, owners = np.concatenate(found).astype(np.int64), np.concatenate(owners)
    if grams > 1:
        order = np.argsort(owners, kind="stable")
        found, owners = found[order], owners[order]
    return found, owners, counts


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket over all rows of ``texts``: at most ``buckets`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            held += np.bincount(feature_buckets(batch.column("text"), grams, buckets)[0], minlength=buckets)
        met = np.flatnonzero(held)
        yield pa.record_batch({"bucket": pa.array(met, pa.int32()), "n": pa.array(held[met], pa.int64())})

    parts = texts.select("text").mapInArrow(run, "bucket int, n long")
    result = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        result[row["bucket"]] = row["n"]
    return result


def bucket_gains(given: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket, in doubles."""
    size, held, aimed = len(given), float(given.sum()), float(target.sum())
    ratios = (
        (t + 1.0) * (held + size) / ((s + 1.0) * (aimed + size))
        for s, t in zip(given.tolist(), target.tolist())
    )
    return np.array([math.floor(_SCALE * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of sha256("seed:doc_id")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(text, 256), 1, 8)
    unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-_SCALE * F.log(-F.log(unit))).cast("long")


def weigh(docs: DataFrame, gains: np.ndarray, grams: int = GRAMS, seed: int = SEED) -> DataFrame:
    """doc_id, text_hash, n_words, n_features, weight and score of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.num_rows
            found, owners, words = feature_buckets(batch.column("text"), grams, len(gains))
            features = np.bincount(owners, minlength=rows)
            totals = np.zeros(rows, np.int64)
            if len(found):
                firsts = np.flatnonzero(np.diff(owners, prepend=-1))
                totals[owners[firsts]] = np.add.reduceat(gains[found], firsts)
            columns = {c: batch.column(c) for c in ("doc_id", "text_hash")}
            yield pa.record_batch(
                columns
                | {
                    "n_words": pa.array(words, pa.int64()),
                    "n_features": pa.array(features, pa.int64()),
                    "weight": pa.array(totals // np.maximum(features, 1), pa.int64()),
                }
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    fields = f"doc_id {kind}, text_hash long, n_words long, n_features long, weight long"
    weighed = rows.mapInArrow(run, fields)
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _cut(by_score: list, drawn: int) -> int | None:
    """The least score that is drawn; ``by_score`` has (score, rows) from the highest score on."""
    reached = 0
    for score, rows in by_score:
        reached += rows
        if reached >= drawn:
            return score
    return None


def drawn_first(scored: DataFrame, percent: int, least: int = LEAST) -> DataFrame:
    """``scored`` (a stored table) with ``rank``: 1, 2, ... for the drawn rows, null for all others."""
    counted = scored.filter(F.col("n_words") >= least).groupBy("score").count()
    # Scores are whole thousandths of logarithms, so there are some ten thousand of them at any size.
    by_score = [tuple(r) for r in counted.orderBy(F.desc("score")).collect()]
    drawn = percent * sum(n for _, n in by_score) // 100
    cut = _cut(by_score, drawn) if drawn else None
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = (F.col("n_words") >= least) & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_hash")]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = scored.filter(near).repartitionByRange(*order).sortWithinPartitions(*order)
    # Written, so that numbers of partitions and places stay as they are from here on.
    numbered = stored(sorted_rows.withColumns({"__part": F.spark_partition_id(), "__place": place}), "drawn")
    before, starts = 0, []
    for row in numbered.groupBy("__part").count().orderBy("__part").collect():  # a row a task
        starts.append((row["__part"], before))
        before += row["count"]
    offsets = scored.sparkSession.createDataFrame(starts, "__part int, __before long")
    rank = F.col("__before") + F.col("__place") + 1
    ranked = numbered.join(F.broadcast(offsets), "__part").withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.filter(~near).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    least: int = LEAST,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, text_hash, n_words, n_features, weight, score and rank of every row of ``docs``.

    ``percent`` of the rows with at least ``least`` words are drawn.
    """
    gains = bucket_gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    scored = stored(weigh(docs, gains, grams, seed), "weighed")
    return drawn_first(scored, percent, least)
