"""Near duplicates by 64-bit SimHash, with pigeonring filtering of candidates.

A fingerprint is cut into ``SEGMENTS`` equal segments on a ring. If two fingerprints differ in
at most ``BUDGET`` bits, some start segment exists from which every chain of l consecutive
segments differs in at most l * BUDGET / SEGMENTS bits (the pigeonring principle). The longest
chain whose budget is below one bit must be equal, so it is the join key; the longer chains
are checked next, the full Hamming distance last.

Only distinct fingerprints are joined, so copies cost nothing. A key that more than
``BUCKET`` distinct fingerprints share is not paired off: its members are linked through
midpoints instead. Two fingerprints are within two bits exactly when some value is within one
bit of both, so each member emits itself and its 64 neighbours, and members that meet at one
value are linked; at most 65 distinct fingerprints can meet there. Both ways are exact.

Null texts have no words; texts without words have fingerprint zero and link like any other.
Rows with equal doc_id are separate rows; a null doc_id never names a component. An empty table
gives an empty result, and columns beyond doc_id and text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import slices, stored
from candleforge.llm.components import smallest_mates

BITS = 64
BUDGET = 2
SEGMENTS = 16
BUCKET = 64
SHINGLE = 3
SEED = 42

_BLOCK = 1 << 16  # hashes whose bits are counted at a time


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        octets = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes)).view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [fingerprint(t) for t in batch.column("text").to_pylist()]
        signed = pa.array(np.array(found, np.uint64).view(np.int64))
        kept = [batch.column(c) for c in batch.schema.names if c != "text"]
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.record_batch([*kept, signed], names=[*names, "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (of the whole text, to tell rows with one id apart), fp (as a long)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_fingerprints, f"doc_id {kind}, text_hash long, fp long")


def _rotated(value: Column, start: Column) -> Column:
    by = start * (BITS // SEGMENTS)
    # A shift by 64 is one by 0, so start 0 gives the value itself.
    left = F.call_function("shiftleft", value, by)
    return left.bitwiseOR(F.call_function("shiftrightunsigned", value, BITS - by))


def _chain(rotated: Column, segments: int) -> Column:
    """The first ``segments`` segments, as a number."""
    return F.shiftrightunsigned(rotated, BITS - segments * (BITS // SEGMENTS))


def links(prints: DataFrame) -> DataFrame:
    """(u, v) links that connect all distinct fingerprints ``fp`` within two bits.

    Every pair within the budget is joined by a path of links, and each link is such a pair.
    """
    equal = (SEGMENTS - 1) // BUDGET
    starts = F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("start")
    keyed = prints.select("fp", starts).select(
        "fp", "start", _chain(_rotated(F.col("fp"), F.col("start")), equal).alias("key")
    )
    sizes = keyed.groupBy("start", "key").count().filter("count > 1")
    shared = stored(keyed.join(sizes, ["start", "key"]), "chains")

    cold = shared.filter(F.col("count") <= BUCKET)
    left = cold.select("start", "key", F.col("fp").alias("u"))
    right = cold.select("start", "key", F.col("fp").alias("v"))
    pairs = left.join(right, ["start", "key"]).filter("u < v")
    ring = _rotated(F.col("u").bitwiseXOR(F.col("v")), F.col("start"))
    for chain in range(equal + 1, SEGMENTS + 1):
        if chain == SEGMENTS or (chain + 1) * BUDGET // SEGMENTS > chain * BUDGET // SEGMENTS:
            # Shorter chains with the same budget are implied.
            pairs = pairs.filter(F.bit_count(_chain(ring, chain)) <= chain * BUDGET // SEGMENTS)
    exact = pairs.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= BUDGET).select("u", "v")

    hot = shared.filter(F.col("count") > BUCKET).select("fp").distinct()
    around = F.concat(
        F.array(F.col("fp")),
        F.transform(
            F.sequence(F.lit(0), F.lit(BITS - 1)),
            lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.expr("1L"), i)),
        ),
    )
    meeting = (
        hot.select("fp", F.explode(around).alias("middle"))
        .groupBy("middle")
        .agg(F.collect_list("fp").alias("all"), F.min("fp").alias("v"))
        .filter(F.size("all") > 1)
        .select(F.explode("all").alias("u"), "v")
        .filter("u != v")
        .distinct()
    )
    return exact.unionByName(meeting)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, component_id: the smallest doc_id reachable over links."""
    rows = stored(fingerprints(docs), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    mates = smallest_mates(links(prints)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = prints.join(mates, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(of_print, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component: that with the smallest doc_id.

    Rows with a null id come after all others; equal ids are told apart by the text's hash, and
    of equal rows one stays.
    """
    found = stored(near_duplicates(docs), "components")
    # A component is named by its smallest id; those without any id by their fingerprint.
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    heads = (
        found.groupBy(*[c.alias(f"g{i}") for i, c in enumerate(group)])
        .agg(F.min(key).alias("head"))
        .select(F.col("head.doc_id").alias("__near_id"), F.col("head.text_hash").alias("__near_hash"))
    )
    repeats = found.groupBy("doc_id", "text_hash").count().filter("count > 1")
    heads = heads.join(
        repeats.select(F.col("doc_id").alias("__near_i"), F.col("text_hash").alias("__near_h"), "count"),
        F.col("__near_id").eqNullSafe(F.col("__near_i")) & F.col("__near_hash").eqNullSafe(F.col("__near_h")),
        "left",
    ).select("__near_id", "__near_hash", F.col("count").isNotNull().alias("__near_repeated"))
    kept = docs.withColumn("__near_text_hash", F.xxhash64("text")).join(
        heads,
        F.col("doc_id").eqNullSafe(F.col("__near_id")) & (F.col("__near_text_hash") == F.col("__near_hash")),
    )
    single = kept.filter(~F.col("__near_repeated")).select(*docs.columns)
    # Only rows that repeat an earlier one in id and text are shuffled again.
    merged = kept.filter("__near_repeated").dropDuplicates(["doc_id", "__near_text_hash"]).select(*docs.columns)
    return single.unionByName(merged)
