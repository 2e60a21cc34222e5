"""Nulls, empty texts and tables, repeated rows, long texts and clashing columns."""

from __future__ import annotations

import public_tokenizers
import pytest

from candleforge.llm import (
    chat,
    decontaminate,
    language,
    merge_replay,
    quality_rules,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    transducer,
)

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, n_tokens string, fp string, score string, items int"
LABELS = "doc_id long, quality int, toxic int"

RUNS = {
    "quality": lambda d, b, l: quality_rules.judge(d, l),
    "files": lambda d, b, l: token_files.round_trip(d, JSON),
    "toxicity": lambda d, b, l: toxicity.scored(d, toxicity.learn(d, l)),
    "secrets": lambda d, b, l: secret_scan.redact(d, secret_scan.cuts(d)),
    "language": lambda d, b, l: language.identify(d, language.profiles(d)),
    "replay": lambda d, b, l: merge_replay.encode(d, RANKS, public_tokenizers.PATTERN),
    "overlaps": lambda d, b, l: decontaminate.overlaps(d, b),
    "simhash": lambda d, b, l: simhash.near_duplicates(d),
    "counts": lambda d, b, l: transducer.count_tokens(d, JSON),
}


def tables(spark, rows):
    docs = spark.createDataFrame([(*row, None, "x", "y", "z", 1) for row in rows], SCHEMA)
    items = [(1, None), (2, ""), (None, "a b"), (3, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    labels = spark.createDataFrame([(1, None, None)], LABELS)
    return docs, bench, labels


@pytest.mark.parametrize("name", RUNS)
def test_edges(spark, name):
    rows = [(None, None), (1, ""), (1, ""), (2, "one two " * 30_000), (2, None), (3, "\n \t")]
    assert RUNS[name](*tables(spark, rows)).count() == len(rows)
    assert RUNS[name](*tables(spark, [])).count() == 0


def test_one_of_equal_rows_stays(spark):
    docs, bench, _ = tables(spark, [(5, "a b c d"), (5, "a b c d"), (6, "a b c d"), (None, None)])
    kept = sorted((r.doc_id or 0, r.text or "") for r in simhash.keep_one(docs).collect())
    assert kept == [(0, ""), (5, "a b c d")]
    assert simhash.keep_one(docs).columns == docs.columns
    assert decontaminate.decontaminate(docs, bench).columns == docs.columns


def test_chat_edges(spark):
    kind = "conv_id long, turn int, role string, text string"
    rows = [(1, 0, None, None), (None, 1, "user", "<|</s>\\<s>"), (1, 0, "a|>\n", "[INST]\\")]
    back = chat.parse(chat.render(spark.createDataFrame(rows, kind))).collect()
    found = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back}
    assert found == {1: [("", ""), ("a|>\n", "[INST]\\")], None: [("user", "<|</s>\\<s>")]}
    assert chat.render(spark.createDataFrame([], kind)).count() == 0
