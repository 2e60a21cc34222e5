"""Clashing columns, empty tables, hot keys and segments of the operators on texts."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from candleforge.llm import chat, merge_replay, secret_scan, simhash, token_files  # noqa: E402
from candleforge.llm.components import smallest_mates  # noqa: E402

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_segments_make_up_the_text(spark):
    rows = [
        (1, 0, "system", "be <|kind|>"), (1, 1, "user", "hi\\"), (1, 2, "assistant", "</s>[INST]"),
        (2, 0, "assistant", "first"), (2, 1, "user", None), (2, 2, "assistant", ""),
        (3, 0, None, "x"), (None, 0, "user", "a"), (None, 0, "assistant", "b"), (None, 0, "assistant", "b"),
    ]
    found = {r.conv_id: r for r in chat.render(spark.createDataFrame(rows, TURNS)).collect()}
    for row in found.values():
        assert "".join(s.text for s in row.segments) == row.formatted
        spans, at = [], 0
        for segment in row.segments:
            if segment.loss:
                spans.append((at, len(segment.text)))
            at += len(segment.text)
        assert spans == [tuple(s) for s in row.loss_spans]
    assert [found[n].valid_order for n in (1, 2, 3)] == [True, False, False]
    assert [found[n].first_invalid for n in (1, 2, 3)] == [None, 0, 0]
    # Turns without a move count by their role.
    assert [s.loss for s in found[2].segments[1::3]] == [True, False, True]
    assert len(found[None].loss_spans) == 2


def test_chat_follows_another_machine(spark):
    template = chat.Template(
        moves={"start": {"user": chat.Move("asked", loss=True)}, "asked": {"assistant": chat.Move("start")}},
        accepting=("start",), loss=(),
    )
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "user", "s")]
    row = chat.render(spark.createDataFrame(rows, TURNS), template).first()
    assert [s.loss for s in row.segments[1::3]] == [True, False, True, False]
    assert (row.valid_order, row.first_invalid) == (False, 3)


def test_chat_empty_and_clashing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.parse(chat.render(empty)).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], TURNS)
    clash = rows.selectExpr("*", "'h' as head", "1 as n", "2 as size", "'s' as segments", "'f' as formatted", "3 as walk")
    found, plain = (chat.parse(chat.render(r)).first() for r in (clash, rows))
    assert found == plain and [t.text for t in found.turns] == ["q", "a"]


def test_secrets_beside_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "password=abcdefgh12", 99), (2, None, 5)], "doc_id long, text string, n_chars long")
    docs = docs.selectExpr("*", "'x' as secrets", "1 as step", "2 as met")
    cut = secret_scan.cuts(docs)
    found = {r.doc_id: r for r in secret_scan.scan(docs, cut).collect()}
    assert [s.kind for s in found[1].secrets] == ["assign"] and found[2].secrets == [] and found[1].step == 1
    kept = {r.doc_id: r for r in secret_scan.redact(docs, cut).collect()}
    assert kept[1].text == "[SECRET]" and kept[1].n_chars == 8 and kept[1].secrets == "x"
    assert kept[2].text is None and kept[2].n_chars == 5


def test_encoding_beside_clashing_columns(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "\0<|x")], "doc_id long, text string")
    docs = docs.selectExpr("*", "'i' as ids", "0 as n_tokens", "'d' as decoded")
    rows = merge_replay.encode(docs, path, public_tokenizers.PATTERN, round_trip=False)
    back = {r.doc_id: bytes(r.decoded) for r in merge_replay.decode(rows, path).collect()}
    assert back == {1: b"a b", 2: b"", 3: b"\0<|x"}


def test_fingerprints_that_share_a_key_in_masses(spark):
    # More than BUCKET fingerprints with one chain key: they are linked through midpoints.
    made = random.Random(4)
    base = made.getrandbits(64)
    prints = {base}
    for _ in range(300):
        prints.add(base ^ (1 << made.randrange(24)) ^ (1 << made.randrange(24)) ^ (1 << made.randrange(24)))
    prints |= {made.getrandbits(64) for _ in range(50)}
    ordered = sorted(prints)
    assert len(ordered) > 2 * simhash.BUCKET
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in ordered]
    frame = spark.createDataFrame(signed, "fp long")
    mates = {r.u: r.v for r in smallest_mates(simhash.links(frame)).collect()}
    groups = {}
    for p, (s,) in zip(ordered, signed):
        groups.setdefault(mates.get(s, s), set()).add(p)
    want = {}
    for p, _, component in brute.components([(p, p) for p in ordered]):
        want.setdefault(component, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("length", [1, 7, 64])
def test_token_files_over_many_batches(spark, folder, length):
    made = random.Random(length)
    docs = [(n, " ".join(made.choice(["one", "two", "x<|endoftext|>", "\n\n", "9"]) for _ in range(made.randint(0, 90)))) for n in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    path = public_tokenizers.path("byte_bpe_50k.json")
    files = token_files.write(frame, path, f"file://{folder}", length)
    found = sorted(tuple(r) for r in token_files.read_digests(*files).collect())
    library = token_files._library(path)
    want = brute.stream([t for _, t in docs], library.tokenizer)
    assert [r[1:] for r in found] == want
