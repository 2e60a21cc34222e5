"""The source audit on small tables, against a plain version and its SQL."""

from __future__ import annotations

import os
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candleforge.llm import divergence, oracles  # noqa: E402

FIELDS = "doc_id long, text string, lang string, source string"


def plain(rows, least, ranks=50):
    """(lang, source, part, item, value, rank) by whole numbers."""
    groups, docs = set(), defaultdict(set)
    counts = defaultdict(Counter)
    for n, (_, text, lang, source) in enumerate(rows):
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower):
            docs[lang, term].add(n)
            counts[lang, source][term] += 1
    found = []
    for lang in {lang for lang, _ in groups}:
        kept = [t for (l, t), own in docs.items() if l == lang and len(own) >= least]
        sources = sorted(s for l, s in groups if l == lang)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}

        def share(n, whole):
            return 1 + 10**9 * (n + 5) // (whole + 5 * len(kept))

        p = {s: {t: share(counts[lang, s][t], total[s]) for t in kept} for s in sources}
        whole = sum(total.values())
        q = {t: share(sum(counts[lang, s][t] for s in sources), whole) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, listed, most in (("pair", pairs, None), ("term", terms, ranks)):
                listed.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(listed[:most], 1):
                    found.append((lang, s, part, item, value, rank))
    return sorted(found)


def audited(spark, rows, least, ranks=50):
    docs = spark.createDataFrame(rows, FIELDS)
    found = divergence.audit(docs, least, ranks)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in found.select(*columns).collect())


ROWS = [
    (1, "The cat, the CAT and \xc9t\xe9!", "en", "a"),
    (2, "cat dog dog", "en", "b"),
    (2, "cat dog dog", "en", "b"),
    (None, "dog2dog_dog\x00cat", "en", "c"),
    (3, None, "en", "d"),
    (4, "", None, "a"),
    (5, "cat", None, None),
    (6, "cat", "", "z"),
    (7, "\U0001f600 na\xefve 中文", "fr", "a"),
]


@pytest.mark.parametrize("least", [1, 2, 100])
def test_small_rows(spark, least):
    assert audited(spark, ROWS, least) == plain(ROWS, least)


def test_many_ties_and_a_rank_limit(spark):
    made = random.Random(3)
    words = [f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(200)] + ["\xdf", "\xe9a", "zz"]
    rows = [
        (n, " ".join(made.choice(words) for _ in range(made.randint(0, 60))), made.choice(["x", "y"]), f"s{made.randint(0, 6)}")
        for n in range(400)
    ]
    rows += [(n, "one one one two", "x", "s0") for n in range(300)]
    assert audited(spark, rows, 30, 7) == plain(rows, 30, 7)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], FIELDS)
    assert divergence.audit(empty).collect() == []
    docs = spark.createDataFrame(ROWS, FIELDS).selectExpr("*", "1 as n", "2 as run", "3 as key", "'k' as term", "0 as rank")
    found = divergence.audit(docs, 1).collect()
    assert len(found) == len(plain(ROWS, 1))


def test_a_very_long_text(spark):
    rows = [(1, "alpha beta " * 200_000, "en", "a"), (2, "beta gamma", "en", "b")]
    assert audited(spark, rows, 1) == plain(rows, 1)


@pytest.mark.parametrize("portion", [1, 2, 5, 1000])
def test_runs_are_merged_in_order_without_parting_a_key(monkeypatch, portion):
    monkeypatch.setattr(divergence, "_ROWS", portion)
    made, want, runs = random.Random(portion), Counter(), []
    for _ in range(7):
        rows = Counter()
        for _ in range(made.randint(0, 40)):
            rows[made.choice("abcdefgh").encode(), made.choice("st")] += made.randint(1, 3)
        want.update(rows)
        keys, sources = zip(*sorted(rows)) if rows else ((), ())
        n = [rows[k] for k in sorted(rows)]
        runs.append(
            divergence._Run(
                pa.table(
                    {"key": pa.array(keys, pa.binary()), "source": pa.array(sources, pa.string()),
                     "docs": pa.array(n, pa.int64()), "n": pa.array(n, pa.int64())}
                )
            )
        )
    got, last = Counter(), b""
    for part in divergence.merged(runs):
        keys = part.column("key").to_pylist()
        assert keys == sorted(keys) and keys[0] > last
        last = keys[-1]
        got.update(dict(zip(zip(keys, part.column("source").to_pylist()), part.column("n").to_pylist())))
    assert got == want


def test_shard_merges_what_it_holds(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    made, batches, docs = random.Random(1), [], Counter()
    for run in range(40):
        rows = sorted({(b"en\0" + made.choice("abcdefg").encode(), made.choice("st")) for _ in range(5)})
        docs.update(k for k, _ in rows)
        keys, sources = zip(*rows)
        ones = pa.array([1] * len(rows), pa.int64())
        batches.append(
            pa.record_batch(
                {"key": pa.array(keys, pa.binary()), "source": pa.array(sources), "docs": ones, "n": ones,
                 "run": pa.array([run] * len(rows), pa.int64())}
            )
        )
    made.shuffle(batches)
    found = pa.Table.from_batches(divergence._merge_shard(28)(iter(batches))).to_pylist()
    want = {k.split(b"\0")[1]: n for k, n in docs.items() if n >= 28}
    totals = {row["term"]: row["term_n"] for row in found}
    assert want and len(want) < 7 and totals == want and sum(r["first"] for r in found) == len(want)


def test_sql_is_the_same(spark):
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for r in docs.to_pylist()]
    con = duckdb.connect()
    con.register("documents", docs)
    found = con.execute(oracles.ORACLES["op11_divergence"]).fetchall()
    assert sorted(found) == plain(rows, 30)
