"""The n-gram join against all pairs, on small tables."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from candleforge.llm import jaccard_join, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def plain_set(text):
    own = [w.translate({n: n + 32 for n in range(65, 91)}) for w in brute.words(text)]
    return {tuple(own[n : n + 5]) for n in range(max(len(own) - 4, 1))} if own else set()


def plain(docs):
    """(doc_id, n_shingles, component_id) of each row, by comparing all distinct sets."""
    sets = [plain_set(text) for _, text in docs]
    distinct = list({frozenset(s) for s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for n, a in enumerate(distinct):
        for b in distinct[:n]:
            shared = len(a & b)
            if 100 * shared >= 80 * (len(a) + len(b) - shared):
                root[find(a)] = find(b)
    least = {}
    for (doc_id, _), own in zip(docs, sets):
        if own and doc_id is not None:
            top = find(frozenset(own))
            least[top] = min(doc_id, least.get(top, doc_id))
    rows = []
    for (doc_id, _), own in zip(docs, sets):
        rows.append((doc_id, len(own), least.get(find(frozenset(own))) if own else doc_id))
    return sorted(rows, key=str)


def joined(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted((tuple(r) for r in jaccard_join.join(frame).collect()), key=str)


def varied(seed, copies):
    """Texts with near copies on both sides of the threshold, and a passage that all share."""
    made = random.Random(seed)
    words = [f"w{n}" for n in range(3000)]
    passage = [made.choice(words) for _ in range(60)]
    docs = []
    for _ in range(12):
        base = [made.choice(words) for _ in range(made.randint(3, 200))]
        for copy in range(copies):
            own = list(base)
            for _ in range(made.randint(0, max(1, len(own) // 40))):
                own[made.randrange(len(own))] = made.choice(words)
            if copy % 3 == 0:
                own = own + passage
            docs.append((made.randrange(10**6), " ".join(own)))
    return docs


def test_the_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()]
    found = queries.QUERIES["op12_jaccard_join"](spark, SF_DIR)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(docs)


def test_near_copies_and_shared_passages(spark):
    docs = varied(1, 12)
    assert joined(spark, docs) == plain(docs)


def test_large_trees_are_joined_by_their_leaves(spark, monkeypatch):
    # Trees of more than two points are dealt, and no round of pivots helps.
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 0)
    docs = varied(2, 10)
    assert joined(spark, docs) == plain(docs)


def counted(monkeypatch, label):
    """(rows, distinct rows) of pairs that were stored under a label, filled as the join runs."""
    seen, write = [], jaccard_join.stored

    def watched(df, name):
        out = write(df, name)
        if name == label:
            pairs = out.filter("u is not null").select("u", "v")
            seen.append((pairs.count(), pairs.distinct().count()))
        return out

    monkeypatch.setattr(jaccard_join, "stored", watched)
    return seen


def shared_most(count, spots):
    """Texts that share most words, too few to link, in a group that no round merges."""
    made = random.Random(4)
    base = [f"b{n}" for n in range(1200)]
    docs = []
    for n in range(count):
        own = list(base)
        for spot in made.sample(range(len(own)), spots):
            own[spot] = f"o{n}x{spot}"
        docs.append((n, " ".join(own)))
    return docs


def test_a_pair_is_met_in_one_tree_only(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIVOTS", 0)
    seen = counted(monkeypatch, "searched")
    docs = shared_most(30, 21)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert joined(spark, docs) == plain(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ((rows, distinct),) = seen
    assert rows == distinct > 300


@pytest.mark.parametrize("block", [2, 2048])
@pytest.mark.parametrize("earlier", [1, 3])
def test_few_earlier_trees_lose_no_pair(spark, monkeypatch, earlier, block):
    monkeypatch.setattr(jaccard_join, "EARLIER", earlier)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 1)
    docs = varied(3, 8) + [(n + 10**7, text) for n, text in shared_most(8, 12)]
    assert joined(spark, docs) == plain(docs)


def test_shingles_of_the_same_sets_are_one_tree(spark):
    words = [f"v{n}" for n in range(300)]
    docs = [(n, " ".join([*words, f"end{n}"])) for n in range(3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    lists = jaccard_join._shared_trees(jaccard_join.distinct_sets(frame).localCheckpoint()).collect()
    assert len(lists) == 3 and len({tuple(own["keys"]) for own in lists}) == 1
    # Of 297 shingles the first 60 open trees; one of them, the rarest, is in no other set.
    assert {tuple(own.weights) for own in lists} == {(59,)}


def test_pairs_of_an_earlier_tree():
    rows = jaccard_join._trees(np.array([2, 0, 1, 1]), np.array([5, 7, 7, 0]))
    a, b = np.indices((4, 4)).reshape(2, -1)
    met = jaccard_join._met_earlier(rows[a], rows[b]).reshape(4, 4)
    assert met.tolist() == [[True, False, True, False], [False] * 4, [True, False, True, False], [False] * 3 + [True]]


EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "Two words"), (5, "two WORDS"), (6, "two words more"),
    (7, "a b c d e"), (7, "A b c d e"), (None, "a b c d e"), (None, None), (8, "x\xa0y z"), (9, "x\xa0y z"),
    (10, "\xc9t\xe9 1 2 3 4"), (11, "\xe9t\xe9 1 2 3 4"), (12, "a a a a a a a a a"), (13, "a a a a a"),
]


def test_edges(spark):
    assert joined(spark, EDGES) == plain(EDGES)
    assert joined(spark, []) == []
    assert joined(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_at_the_threshold(spark):
    words = [f"v{n}" for n in range(200)]
    docs = [(0, " ".join(words[:104]))]
    # Sets of 100 and fewer shingles, all in the first: 80 of 100 link, 79 do not.
    docs += [(1, " ".join(words[:84])), (2, " ".join(words[:83]))]
    assert [r[2] for r in joined(spark, docs)] == [0, 0, 0]
    assert [r[2] for r in joined(spark, [docs[0], docs[2]])] == [0, 2]
    assert [r[2] for r in joined(spark, [docs[0], docs[1]])] == [0, 0]


def test_clashing_columns_and_a_very_long_text(spark):
    long = " ".join(str(n) for n in range(300_000))
    frame = spark.createDataFrame([(1, long), (2, long + " end"), (3, "x")], "doc_id long, text string")
    frame = frame.selectExpr("*", "'m' as mark", "1 as sid", "2 as n", "3 as key", "4 as component_id")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(frame).collect()}
    assert found == {1: (299_996, 1), 2: (299_997, 1), 3: (1, 3)}


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_a_tree_misses_no_pair(monkeypatch, leaf):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    made = np.random.default_rng(leaf)
    points = made.integers(0, 4, (60, jaccard_join.GROUPS)).astype("<u4")
    points[10:30] = points[9] + (made.random((20, jaccard_join.GROUPS)) < 0.1)
    sizes = points.sum(axis=1).astype(np.int64)
    sids, comps = np.arange(60), np.arange(60) // 2
    tree = jaccard_join._Tree(sids, comps, sizes, points)
    found = {(int(u), int(v)) for part in tree.pairs() for u, v, _, _ in part}
    want = {
        (u, v)
        for u in range(60)
        for v in range(u + 1, 60)
        if comps[u] != comps[v]
        and jaccard_join.may_link(int(np.minimum(points[u], points[v]).sum()), sizes[u], sizes[v])
    }
    assert found == want and len(want) > 50


@pytest.mark.parametrize("n", range(1, 60))
def test_prefix_holds_a_shared_shingle(n):
    # Sets of n and m shingles that link share more than the rest behind either prefix.
    for m in range(n, n * 5 // 4 + 1):
        shared = -(-80 * (n + m) // 180)
        if shared <= n:
            assert shared > n - jaccard_join.prefix_size(n) and shared > m - jaccard_join.prefix_size(m)
