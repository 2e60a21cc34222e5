"""Benchmark items without an id mark words and documents like all others."""

from __future__ import annotations

from candleforge.llm import decontaminate

LONG = " ".join(f"w{n}" for n in range(30))
OTHER = " ".join(f"v{n}" for n in range(15))


def test_items_without_an_id_are_searched(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, LONG), (2, "nothing of it"), (3, f"{LONG} {OTHER}"), (4, OTHER)], "doc_id long, text string"
    )
    items = [(None, LONG), (7, OTHER), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [
        (1, 30, [], 30, None, True),
        (2, 0, [], 0, None, False),
        (3, 45, ["7"], 30, None, True),
        (4, 15, ["7"], 15, "7", True),
    ]
    columns = ("doc_id", "n_hit", "items", "longest_words", "longest_item", "contaminated")
    for size in (decontaminate.BLOCK_BYTES, 40):  # in one block and in several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        found = decontaminate.overlaps(docs, bench).select(*columns)
        assert sorted(tuple(r) for r in found.collect()) == want
        assert [r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()] == [2]
