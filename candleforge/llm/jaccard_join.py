"""N-gram Jaccard join by count vectors: which documents share most of their word shingles.

A document is the set of its distinct shingles of ``SHINGLE`` words. Two documents link when
``DENOMINATOR`` * |both| >= ``NUMERATOR`` * |either|. Shingles are hashed into ``GROUPS`` groups; a
set is the point of its counts by group. Two sets share at most the sum of the smaller of their
counts, so a pair whose sum is too small for the threshold cannot link. Points are kept
in R-trees: a leaf holds points of similar size under the box of their counts, and a pair of leaves is
left out when even the corners of their boxes share too little.

One tree over all points would compare everything of similar size, so there is a tree for each key.
Of n shingles in a fixed order a set enters the trees of the first n - ceil(0.8 n) + 1; sets that
link have one of these in common. The order puts shingles of many documents last (a bounded list, from
counts over all documents; any order gives the same result), so shared passages seldom open
a tree. Only distinct sets are joined, so copies cost nothing. Shingles that open the same tree, that of
the same sets, are one tree. Near copies still share many trees, so trees are ordered, the largest first,
and two sets are a pair of the first tree they share only: a point knows up to ``EARLIER`` trees of its
set before this one (a pair whose first tree is not among them is only met more often).

First (``ROUNDS`` times) every tree, with the sets that have it among their ``FIRST``, is dealt into parts of some ``BLOCK`` points, anew in each round,
and a part's points are held against ``PIVOTS`` of them. That grows with the points however
large a tree is, and links most of a group of near copies. Trees whose members are then all in
one component are done. The others are searched in full: trees of up to ``BLOCK`` points in one task,
larger ones as leaves dealt over tasks, whose pairs are joined by their boxes. Sets in one component are
not compared again: a component is exact, while links within it are found only as far as they
connect it. A pair whose trees have few shingles beside the size of its sets cannot link either: the
shingles that open no tree are at most as many as the larger rest. Surviving pairs are verified on their
whole texts.

Shingles are 64-bit hashes within a pair (two sets of s shingles are misjudged with a chance of
s * s / 2^64); sets are told apart by 128 bits. A text with fewer words is one shingle. Null texts and
texts without words are empty sets: they link with nothing, and their component is their own doc_id.
Rows with one doc_id are separate rows; a null doc_id never names a component. A very long text is
held whole by the task that reads it. An empty table gives an empty result; columns beyond
doc_id and text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import slices, stored
from candleforge.llm.components import smallest_mates

SHINGLE = 5
NUMERATOR, DENOMINATOR = 80, 100
GROUPS = 128
LEAF = 64
BLOCK = 2048
ROUNDS, PIVOTS = 1, 16
EARLIER = 32
FIRST = 6  # of a set's trees, those that a round looks at: the largest
#: Shingles of many documents that are put last, at most.
COMMON = 250_000

_COUNTED = 4_000_000  # shingles a task counts at a time
_OFTEN = 3  # of them, those met as often are reported

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], np.uint64)
_COUNT = np.dtype("<u4")


def shingles(text: str | None) -> np.ndarray:
    """The set of a text, as sorted hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(hashes))
    places = len(hashes) - size + 1
    mixed = np.full(places, size, np.uint64)
    for k in range(size):
        mixed += hashes[k : k + places] * _MIX[k]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX[0]
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def counts(found: np.ndarray) -> np.ndarray:
    """The point of a set."""
    return np.bincount((found % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype(_COUNT)


def may_link(shared, a, b):
    """Whether sets of sizes a and b with at most ``shared`` in common can reach the threshold."""
    return (NUMERATOR + DENOMINATOR) * shared >= NUMERATOR * (a + b)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return DENOMINATOR * shared >= NUMERATOR * (len(a) + len(b) - shared)


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Hashes of the shingles that most documents hold, the rarest first; at most ``COMMON``."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        met, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= _OFTEN
        return pa.record_batch(
            {"shingle": pa.array(met[often].view(np.int64)), "n": pa.array(n[often].astype(np.int64))}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()
        size = 0
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                own = shingles(text)
                # Copies are one set later on.
                if (mark := _digest(own)) in seen:
                    continue
                seen.add(mark)
                held.append(own)
                size += len(own)
                if size >= _COUNTED:
                    yield counted(held)
                    held, size = [], 0
                    seen.clear()
        if held:
            yield counted(held)

    parts = docs.select("text").mapInArrow(run, "shingle long, n long")
    most = parts.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(COMMON)
    found = most.toArrow()
    n, shingle = (found.column(c).to_numpy() for c in ("n", "shingle"))
    return shingle[np.lexsort((shingle, n))].view(np.uint64)


def prefix_size(n):
    """How many trees a set of n shingles enters: n - ceil(0.8 n) + 1."""
    return n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1


def _prefix(found: np.ndarray, common: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The shingles by which a set enters trees. ``common`` is sorted, with the place of each."""
    size = prefix_size(len(found))
    rank = np.zeros(len(found), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        rank = np.where(common[at] == found, places[at] + 1, 0)
    return found[np.lexsort((found, rank))[:size]]


def distinct_sets(docs: DataFrame) -> DataFrame:
    """mark, first_id, text_mark, n, point and keys of each distinct set that is not empty."""
    listed = common_shingles(docs)
    order = np.argsort(listed)
    common = listed[order]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t) for t in batch.column("text").to_pylist()]
            full = [n for n, f in enumerate(found) if len(f)]
            keys = [_prefix(found[n], common, order) for n in full]
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            kept = pa.array(full, pa.int64())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(kept),
                    "text_mark": batch.column("text_mark").take(kept),
                    "mark": pa.array([_digest(found[n]) for n in full], pa.binary()),
                    "n": pa.array([len(found[n]) for n in full], pa.int64()),
                    "point": pa.array([counts(found[n]).tobytes() for n in full], pa.binary()),
                    "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                }
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_mark"), "text")
    fields = f"doc_id {kind}, text_mark long, mark binary, n long, point binary, keys array<long>"
    profiles = rows.mapInArrow(run, fields)
    # Of the copies of a set, the text with the least id stands for it.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_mark"))
    sets = profiles.groupBy("mark").agg(
        least.alias("least"), *[F.first(c).alias(c) for c in ("n", "point", "keys")]
    )
    return sets.select(
        F.monotonically_increasing_id().alias("sid"), "mark", F.col("least.doc_id").alias("first_id"),
        F.col("least.text_mark").alias("text_mark"), "n", "point", "keys",
    )


def _points(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _COUNT).reshape(-1, GROUPS)


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The (u, v) pairs that link, by the sets of their whole texts."""
    involved = pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct()
    asked = sets.join(involved, "sid", "left_semi").select("sid", "mark", "first_id", "text_mark")
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark_here"), "text")
    found = rows.join(
        asked,
        (F.col("mark_here") == F.col("text_mark")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
    )
    # Rows that repeat in id and text count once; texts of equal hash are told apart by the mark.
    texts = found.groupBy("sid", "mark").agg(F.explode(F.collect_set("text")).alias("text"))
    texts = stored(texts, "joined-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t_u"):
            names = ("u", "v", "m_u", "m_v", "t_u", "t_v")
            held: dict[bytes, np.ndarray] = {}
            links = []
            for u, v, m_u, m_v, t_u, t_v in zip(*(batch.column(c).to_pylist() for c in names)):
                both = []
                for mark, text in ((m_u, t_u), (m_v, t_v)):
                    if mark not in held:
                        own = shingles(text)
                        if _digest(own) != mark:
                            break
                        held[mark] = own
                    both.append(held[mark])
                if len(both) == 2 and linked(*both):
                    links.append((u, v))
            u, v = zip(*links) if links else ((), ())
            yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    for side in ("u", "v"):
        own = texts.select(F.col("sid").alias(side), F.col("mark").alias(f"m_{side}"), F.col("text").alias(f"t_{side}"))
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(run, "u long, v long")


class _Tree:
    """The points of one tree, by size, in leaves."""

    def __init__(
        self, sids: np.ndarray, comps: np.ndarray, sizes: np.ndarray, points: np.ndarray, earlier: np.ndarray | None = None
    ):
        order = np.lexsort((sids, sizes))
        self.sids, self.comps, self.sizes, self.points = sids[order], comps[order], sizes[order], points[order]
        self.earlier = _trees(np.zeros(len(sids), np.int64), _NO_TREES) if earlier is None else earlier[order]
        self.starts = np.arange(0, len(order), LEAF)
        self.corners = np.maximum.reduceat(self.points, self.starts, axis=0)

    def pairs(self) -> Iterator[np.ndarray]:
        """Pairs of different components that the points leave room for."""
        for a in range(len(self.starts)):
            first = self.leaf(a)
            for b in range(a, len(self.starts)):
                smaller, larger = self.sizes[self.starts[a]], self.sizes[self.starts[b]]
                # Leaves come by size, and a set cannot link with one that is too much larger.
                if not may_link(self.sizes[first][-1], self.sizes[first][-1], larger) and b > a:
                    break
                top = np.minimum(self.corners[a], self.corners[b]).sum(dtype=np.int64)
                if may_link(top, smaller, larger):
                    yield _leaf_pairs(self.members(a), self.members(b), a == b)

    def leaf(self, number: int) -> slice:
        return slice(self.starts[number], self.starts[number] + LEAF)

    def members(self, number: int) -> tuple[np.ndarray, ...]:
        at = self.leaf(number)
        return self.sids[at], self.comps[at], self.sizes[at], self.points[at], self.earlier[at]


_NO_TREES = np.empty(0, np.int64)


def _trees(lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Lists of trees as rows of ``EARLIER`` numbers, filled up with -1."""
    rows = np.full((len(lengths), EARLIER), -1, np.int64)
    rows[np.arange(EARLIER) < lengths[:, None]] = flat
    return rows


def _met_earlier(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of a and b, side by side, have a tree in common."""
    met = np.zeros(len(a), bool)
    for low in range(0, len(a), 2048):
        x, y = a[low : low + 2048], b[low : low + 2048]
        for k in range(EARLIER):
            met[low : low + 2048] |= ((y == x[:, k : k + 1]) & (y >= 0)).any(axis=1)
    return met


def _leaf_pairs(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], same: bool) -> np.ndarray:
    """(u, v, size of u, size of v) rows between the points of two leaves, or within one, but for pairs of
    an earlier tree."""
    shared = np.minimum(a[3][:, None, :], b[3][None, :, :]).sum(axis=2, dtype=np.int64)
    room = may_link(shared, a[2][:, None], b[2][None, :]) & (a[1][:, None] != b[1][None, :])
    if same:
        room = np.triu(room, 1)
    i, j = np.nonzero(room)
    new = ~_met_earlier(a[4][i], b[4][j])
    i, j = i[new], j[new]
    swap = a[0][i] > b[0][j]
    u, v = (np.where(swap, y, x) for x, y in ((a[0][i], b[0][j]), (b[0][j], a[0][i])))
    n_u, n_v = (np.where(swap, y, x) for x, y in ((a[2][i], b[2][j]), (b[2][j], a[2][i])))
    return np.stack([u, v, n_u, n_v], axis=1)


_PAIRS = 1_000_000  # pairs a task collects before it hands them out

_FOUND = (
    "u long, v long, key long, leaf long, corner array<int>, least long, most long, "
    "one_comp long, sids binary, comps binary, sizes binary, points binary, earlier binary"
)
_FOUND_TYPES = {
    "u": pa.int64(), "v": pa.int64(), "key": pa.int64(), "leaf": pa.int64(),
    "corner": pa.list_(pa.int32()), "least": pa.int64(), "most": pa.int64(), "one_comp": pa.int64(),
    "sids": pa.binary(), "comps": pa.binary(), "sizes": pa.binary(), "points": pa.binary(),
    "earlier": pa.binary(),
}


def _found(rows: list[dict]) -> pa.RecordBatch:
    return pa.record_batch(
        {name: pa.array([r.get(name) for r in rows], kind) for name, kind in _FOUND_TYPES.items()}
    )


def _searching(pivots: int | None, seed: int = 0):
    """Rows sorted by (key, salt): pairs of each tree or part with ``pivots`` points of it, or, for
    None, all pairs of whole trees and the leaves of parts."""

    def finished(key: tuple, parts: list, met: list[np.ndarray], number: int):
        columns = [np.concatenate(c) for c in zip(*parts)]
        if pivots is not None:
            order = np.argsort((columns[0] + seed).astype(np.uint64) * _MIX[0])[:pivots]
            met.append(_leaf_pairs([c[order] for c in columns], columns, False))
            return number
        tree = _Tree(*columns)
        if key[2] == 1:
            met.extend(p for p in tree.pairs() if len(p))
            return number
        yield _found([_leaf(tree, n, key[0], number + n) for n in range(len(tree.starts))])
        return number + len(tree.starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        open_key, parts = None, []
        met: list[np.ndarray] = []
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("key", "salt", "parts", "sid", "comp", "n")]
            points = _points(batch.column("point"))
            listed = batch.column("earlier")
            earlier = _trees(listed.value_lengths().to_numpy(), listed.flatten().to_numpy())
            edges = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
            bounds = [0, *edges.tolist(), batch.num_rows]
            for low, high in zip(bounds, bounds[1:]):
                if low == high:
                    continue
                key = tuple(int(c[low]) for c in columns[:3])
                if open_key is not None and key != open_key:
                    number = yield from finished(open_key, parts, met, number)
                    parts = []
                open_key = key
                parts.append([*(c[low:high] for c in columns[3:]), points[low:high], earlier[low:high]])
            if sum(map(len, met)) >= _PAIRS:
                yield _pair_rows(met)
                met = []
        if open_key is not None:
            number = yield from finished(open_key, parts, met, number)
        if met:
            yield _pair_rows(met)

    return run


def _leaf(tree: _Tree, n: int, key: int, number: int) -> dict:
    sids, comps, sizes, points, earlier = tree.members(n)
    return {
        "key": key, "leaf": number, "corner": tree.corners[n].tolist(),
        "least": int(sizes[0]), "most": int(sizes[-1]),
        "one_comp": int(comps[0]) if (comps == comps[0]).all() else None,
        "sids": sids.tobytes(), "comps": comps.tobytes(), "sizes": sizes.tobytes(),
        "points": points.tobytes(), "earlier": earlier.tobytes(),
    }


def _pair_rows(met: list[np.ndarray]) -> pa.RecordBatch:
    """The distinct pairs of a batch."""
    rows = np.unique(np.concatenate(met)[:, :2], axis=0)
    return pa.record_batch(
        {
            name: pa.array(rows[:, n]) if n < 2 else pa.nulls(len(rows), kind)
            for n, (name, kind) in enumerate(_FOUND_TYPES.items())
        }
    )


def _across(leaves: DataFrame) -> DataFrame:
    """Pairs (u, v) between the leaves of large trees, joined by their boxes."""
    boxes = ("leaf", "corner", "least", "most", "one_comp")
    a = leaves.select("key", *[F.col(c).alias(f"a_{c}") for c in boxes])
    b = leaves.select("key", *[F.col(c).alias(f"b_{c}") for c in boxes])
    near = a.join(b, "key").filter(
        (F.col("a_leaf") <= F.col("b_leaf"))
        & may_link(F.least("a_most", "b_least"), F.least("a_most", "b_least"), F.col("b_least"))
        & may_link(F.least("b_most", "a_least"), F.least("b_most", "a_least"), F.col("a_least"))
        & ~F.coalesce(F.col("a_one_comp") == F.col("b_one_comp"), F.lit(False))
    )
    top = F.aggregate(
        F.zip_with("a_corner", "b_corner", lambda x, y: F.least(x, y)),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    near = near.filter(may_link(top, F.col("a_least"), F.col("b_least"))).select("a_leaf", "b_leaf")
    points = ("sids", "comps", "sizes", "points", "earlier")
    for side in ("a", "b"):
        own = leaves.select(F.col("leaf").alias(f"{side}_leaf"), *[F.col(c).alias(f"{side}_{c}") for c in points])
        near = near.join(own, f"{side}_leaf")

    def members(row: dict, side: str) -> tuple[np.ndarray, ...]:
        sids, comps, sizes = (np.frombuffer(row[f"{side}_{c}"], np.int64) for c in points[:3])
        own = np.frombuffer(row[f"{side}_points"], _COUNT).reshape(-1, GROUPS)
        earlier = np.frombuffer(row[f"{side}_earlier"], np.int64).reshape(len(sids), -1)
        return sids, comps, sizes, own, earlier

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "a_points"):
            for row in batch.to_pylist():
                found = _leaf_pairs(members(row, "a"), members(row, "b"), row["a_leaf"] == row["b_leaf"])
                yield pa.record_batch([pa.array(c) for c in found[:, :2].T], names=["u", "v"])

    return near.mapInArrow(run, "u long, v long")


def _shared_trees(sets: DataFrame) -> DataFrame:
    """sid, n, keys and weights of the trees that each set shares with others, the largest tree first. The key
    is a tree's number, its weight the shingles that open it."""
    keyed = sets.select("sid", "n", F.explode("keys").alias("shingle"))
    members = (F.bit_xor(F.xxhash64("sid", F.lit(k))).alias(f"members_{k}") for k in range(2))
    opened = keyed.groupBy("shingle").agg(
        F.min("sid").alias("low"), F.max("sid").alias("high"), F.count("*").alias("size"), *members
    )
    same = opened.filter("low < high").groupBy("low", "high", "size", "members_0", "members_1")
    trees = same.agg(F.min("shingle").alias("shingle"), F.count("*").alias("weight"))
    trees = trees.select(F.monotonically_increasing_id().alias("key"), "shingle", "size", "weight")
    points = keyed.join(stored(trees, "trees"), "shingle")
    own = F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("place"), "key", "weight")))
    lists = points.groupBy("sid", "n").agg(own.alias("own"))
    return lists.select("sid", "n", F.col("own.key").alias("keys"), F.col("own.weight").alias("weights"))


def _tree_points(shared: DataFrame) -> DataFrame:
    """key, sid and earlier trees of the points of all shared trees."""
    placed = shared.select("sid", "keys", F.posexplode("keys").alias("place", "key"))
    return placed.select("key", "sid", F.slice("keys", 1, F.least("place", F.lit(EARLIER))).alias("earlier"))


def _with_room(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """The (u, v) pairs whose trees leave room for a link."""
    for side in ("u", "v"):
        own = F.map_from_arrays("keys", "weights").alias(f"trees_{side}")
        pairs = pairs.join(shared.select(F.col("sid").alias(side), F.col("n").alias(f"n_{side}"), own), side)
    both = F.map_zip_with(
        "trees_u", "trees_v", lambda _, a, b: F.when(a.isNotNull() & b.isNotNull(), a).otherwise(F.lit(0))
    )
    met = F.aggregate(F.map_values(both), F.lit(0).cast("long"), lambda total, x: total + x)
    # Of two sets, all shared shingles up to the end of the shorter prefix open trees of both.
    rest = F.greatest(*[F.col(n) - _prefix_size(F.col(n)) for n in ("n_u", "n_v")])
    return pairs.filter(may_link(met + rest, F.col("n_u"), F.col("n_v"))).select("u", "v")


def _prefix_size(n: Column) -> Column:
    return n - F.call_function("div", NUMERATOR * n + (DENOMINATOR - 1), F.lit(DENOMINATOR)) + 1


def _dealt(shared: DataFrame, sets: DataFrame, links: DataFrame | None, seed: int) -> DataFrame:
    """The points of all trees that are in several components, dealt by key and salt."""
    members = _tree_points(shared)
    if links is None:
        members = members.withColumn("comp", F.col("sid"))
    else:
        mates = smallest_mates(links).select(F.col("u").alias("sid"), F.col("v").alias("root"))
        own = F.coalesce("root", "sid").alias("comp")
        members = members.join(mates, "sid", "left").select("key", "sid", "earlier", own)
    trees = members.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size")
    )
    trees = trees.filter("low < high").select("key", F.ceil(F.col("size") / BLOCK).alias("parts"))
    rows = members.join(trees, "key").join(sets.select("sid", "n", "point"), "sid")
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("sid", F.lit(seed)), F.col("parts")))
    ordered = dealt.repartition("key", "salt").sortWithinPartitions("key", "salt")
    return ordered.select("key", "salt", "parts", "sid", "comp", "n", "point", "earlier")


def links(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v) links between distinct sets that connect all linked ones."""
    shared = stored(_shared_trees(sets), "shared")
    first = shared.withColumns({c: F.slice(c, 1, FIRST) for c in ("keys", "weights")})

    found, tried = None, None
    for seed in range(ROUNDS):
        near = _dealt(first, sets, found, seed).mapInArrow(_searching(PIVOTS, seed), _FOUND)
        new = near.select("u", "v").distinct()
        if tried is not None:
            new = new.join(tried, ["u", "v"], "left_anti")
        new = stored(_with_room(new, shared), "tried")
        tried = new if tried is None else tried.unionByName(new)
        linked_now = stored(verified(new, sets, docs), "round-links")
        found = linked_now if found is None else found.unionByName(linked_now)

    searched = _dealt(shared, sets, found, ROUNDS).mapInArrow(_searching(None), _FOUND)
    searched = stored(searched, "searched")
    pairs = searched.filter("u is not null").select("u", "v")
    pairs = pairs.unionByName(_across(searched.filter("leaf is not null"))).distinct()
    last = stored(_with_room(pairs.join(tried, ["u", "v"], "left_anti"), shared), "pairs")
    return found.unionByName(stored(verified(last, sets, docs), "last-links"))


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and mark (null for the empty set) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(f) for f in found], pa.int64()),
                    "mark": pa.array([_digest(f) if len(f) else None for f in found], pa.binary()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, mark binary")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable over links, of each row."""
    docs = docs.select("doc_id", "text")
    sets = stored(distinct_sets(docs), "sets")
    mates = smallest_mates(links(sets, docs)).select(F.col("u").alias("sid"), F.col("v").alias("root"))
    rooted = sets.select("sid", "mark", "first_id").join(mates, "sid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "sid"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = rooted.join(least, "root").select("mark", "component_id")
    rows = _named(docs).join(component, "mark", "left")
    own = F.when(F.col("mark").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"))
