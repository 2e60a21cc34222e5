"""The registered queries against plain versions, on whole small tables."""

from __future__ import annotations

import os
import sys

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from candleforge.llm import merge_replay, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def given(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def documents():
    return given("documents")


def result(spark, name, *columns):
    frame = queries.QUERIES[name](spark, SF_DIR)
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def test_quality_rules(spark, documents):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = result(spark, "op1_quality_rules", "doc_id", *columns, "kept")
    assert [r[:-1] for r in found] == sorted((d["doc_id"], *brute.quality(d["text"])) for d in documents)
    assert not any(row[-1] and row[-2] for row in found)
    assert any(row[-1] for row in found)


def test_token_files(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ordered = sorted(documents, key=lambda d: d["doc_id"])
    rows = brute.stream([d["text"] for d in ordered], tokenizer)
    found = result(spark, "op2_token_files", "doc_id", "start", "n_tokens", "ids_crc32")
    assert found == [(d["doc_id"], *r) for d, r in zip(ordered, rows)]


def test_secret_scan(spark, documents):
    found = result(spark, "op4_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    want = sorted((d["doc_id"], *brute.secrets(d["text"])) for d in documents)
    assert [r[:-1] for r in found] == [w[:-1] for w in want]
    for have, plain in zip(found, want):
        assert [s for s in have[-1].split(",") if not s.startswith("random")] == plain[-1].split(",")


def test_merge_replay(spark, documents):
    ranks = merge_replay.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    want = []
    for d in documents:
        ids = library.encode_ordinary(d["text"] or "")
        text = " ".join(map(str, ids))
        want.append((d["doc_id"], len(ids), brute.sha(text), brute.sha(d["text"] or "")))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert result(spark, "op6_merge_replay", *columns) == sorted(want)


def test_decontamination(spark, documents):
    items = [(b["item_id"], b["text"]) for b in given("benchmark")]
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    found = result(spark, "op7_decontamination", *columns)
    assert found == sorted((d["doc_id"], *brute.overlap(d["text"], items)) for d in documents)
    assert any(row[-1] for row in found)


def test_chat_format(spark):
    said = "</s>[INST] ok [/INST]"
    turns = {-7: [(0, "user", said), (1, "assistant", said)]}
    for c in given("conversations"):
        turns.setdefault(c["conv_id"], []).append((c["turn"], c["role"], c["text"]))
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    found = result(spark, "op8_chat_format", *columns)
    assert found == sorted((conv, *brute.conversation(t)) for conv, t in turns.items())


def test_simhash(spark, documents):
    prints = [(d["doc_id"], brute.fingerprint(d["text"])) for d in documents]
    found = result(spark, "op9_simhash", "doc_id", "fingerprint", "component_id")
    assert found == sorted(brute.components(prints))


def test_token_counts(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for d in documents:
        count = len(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids)
        want.append((d["doc_id"], len((d["text"] or "").encode()), count, count > 1024))
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert result(spark, "op10_token_counts", *columns) == sorted(want)
