"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from candleforge.llm import importance, queries

SF_DIR = "/root/testdata/sf0.001"


def features(text, grams=1):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[n : n + size]) for size in range(1, grams + 1) for n in range(len(words) - size + 1)]


def plain(docs, target, grams=1, buckets=10_000, least=20, percent=10, seed=2024):
    """(doc_id, n_features, weight, score, rank) of each row, in order of the rows."""

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(bucket(f) for _, text in docs for f in features(text, grams)[1])
    t = Counter(bucket(f) for text in target for f in features(text, grams)[1])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    rows = []
    for doc_id, text in docs:
        words, own = features(text, grams)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, len(words)])
    ranked = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(ranked[: percent * len(ranked) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def resampled(spark, docs, target, **options):
    given = spark.createDataFrame(docs, "doc_id long, text string")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resample(given, aim, **options)
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=str)


def test_the_query(spark):
    def read(name):
        return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()

    docs = [(d["doc_id"], d["text"]) for d in read("documents")]
    found = queries.QUERIES["op13_importance"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(docs, [b["text"] for b in read("benchmark")])


EDGES = ["Caf\xe9 10 caf\xe9　x", "", None, "a\x00b-c_d", "A a A a", "\U0001f600 \U0001f600", "one", "--- ..."]


@pytest.mark.parametrize("grams", [1, 2, 3])
@pytest.mark.parametrize("buckets", [7, 10_000])
def test_longer_runs(spark, grams, buckets):
    made = random.Random(grams)
    docs = [(n, " ".join(made.choice("ab Ba c1 d".split()) for _ in range(made.randint(0, 30)))) for n in range(120)]
    docs += [(1000 + n, text) for n, text in enumerate(EDGES)]
    target = ["ab c1 ab c1", "ba ab", None, ""]
    options = {"grams": grams, "buckets": buckets, "least": 3, "percent": 40}
    assert resampled(spark, docs, target, **options) == plain(docs, target, **options)


def test_ties_nulls_and_repeats(spark):
    docs = [(n, "same words here") for n in range(50)] + [(None, "same words here")] * 3 + [(7, "same words here")] * 4
    options = {"least": 1, "percent": 50}
    found, want = resampled(spark, docs, ["words"], **options), plain(docs, ["words"], **options)
    assert found == want and sorted(r[4] for r in found if r[4]) == list(range(1, 29))


def test_nothing_to_draw_from(spark):
    assert resampled(spark, [], ["a"]) == []
    assert resampled(spark, [(1, "a b"), (2, None)], []) == plain([(1, "a b"), (2, None)], [])
    everything = resampled(spark, [(1, "a b"), (2, "c")], ["c"], least=0, percent=100)
    assert sorted(r[4] for r in everything) == [1, 2]


def test_clashing_columns_and_a_very_long_text(spark):
    long = "word another " * 300_000
    docs = spark.createDataFrame([(1, long), (2, "word")], "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' as score", "1 as rank", "2 as weight", "3 as text_hash")
    found = {r.doc_id: r for r in importance.resample(docs, docs.limit(0), least=1, percent=100).collect()}
    assert (found[1].n_features, found[2].n_features) == (600_000, 1)


def test_features_of_each_text_come_together():
    texts = pa.array(["b a b", None, "a", ""], pa.string())
    found, owners, words = importance.feature_buckets(texts, 2, 1 << 31)
    assert owners.tolist() == [0] * 5 + [2] and words.tolist() == [3, 0, 1, 0]
    want = [zlib.crc32(f) % (1 << 31) for f in (b"b", b"a", b"b", b"b a", b"a b", b"a")]
    assert found.tolist() == want
