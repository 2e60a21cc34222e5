"""Texts cut into pieces against the libraries on whole texts."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from candleforge.llm import merge_replay, token_files
from candleforge.llm.pieces import cut

TEXTS = [
    "", " ", "  a", "a\n b", "a \n\nb", "a\n \nb", "it's.' x'll\n'tis", "a  b", "a\xa0\nb\u3000c",
    "\0 a\0b", "x<|endoftext|> y", "_a_ b_c", "a\tb \tc", "na\xefve\u2026, x\xb2y 1a2", "a.\n\n", "\n",
    "\nA.", " \n", "\xe9t\xe9!!! \xf7\xd7a", "a\x1c b\x1c\nc", "end.\nNext line, (so)!\n",
]


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_make_up_the_text(text):
    assert "".join(cut(text)) == text


def test_ids_are_those_of_the_libraries():
    library = token_files._library(public_tokenizers.path("byte_bpe_50k.json"))
    for text, packed in zip(TEXTS, library.encode(TEXTS)):
        want = library.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, library.kind).tolist() == want
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding(
        "plain",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=merge_replay.read_ranks(path),
        special_tokens={},
    )
    codec = merge_replay.codec(path, public_tokenizers.PATTERN)
    for text, ids in zip(TEXTS, codec.encode(TEXTS)):
        assert list(ids) == plain.encode_ordinary(text)
