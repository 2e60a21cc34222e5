"""Connected components of a link table, by alternating star operations.

Every round is two grouped minima and two joins; nodes with many links are reduced map-side
in the minima, and adaptive execution splits them in the joins. Rounds are written to the
shared work folder, so a lost executor costs a task and never the rounds before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import stored

LINK = "u long, v long"


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: each node with its smallest known mate."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[above]
        return node

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [n for n in parent if root(n) != n]
    if nodes:
        yield pa.record_batch(
            {"u": pa.array(nodes, pa.int64()), "v": pa.array([root(n) for n in nodes], pa.int64())}
        )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.filter("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _mark(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def smallest_mates(links: DataFrame) -> DataFrame:
    """(u, v): v is the smallest node reachable from u, for every linked node but the smallest.

    ``links`` has long columns u and v, in any direction, with repeats.
    """
    ordered = links.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    stars = stored(ordered.mapInArrow(_contract, LINK), "links")
    mark = _mark(stars)
    while mark[0]:
        stars = stored(_small_star(_large_star(stars)), "links")
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    return stars
