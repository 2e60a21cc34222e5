"""Token counts by deterministic finite-state transducers.

Two machines count the tokens of a byte-level BPE tokenizer without producing them.

The *splitter* finds where the pre-tokenizer's matches begin. It reads classes of characters and
has few states; each transition says whether a match begins at this character and whether one
began at the character before (the pattern looks one character ahead). All texts of a block
form one sequence cut into equal chunks. Each chunk's state map (entry state to exit state) is
computed for all entry states at once, the maps are composed by a parallel prefix scan, and the
chunks are then run from their true entry states, all in step.

The *counter* reads the bytes of a match. Its state is what decides the tokens to come: for each
place from which a longer token may still begin, the token that ends there and the number of
tokens up to there, relative to the present place. A transition emits the change in the number of
tokens. That the state is enough rests on a property of BPE: a sequence of tokens is the encoding
of its bytes exactly if each adjacent pair is the encoding of its own bytes, so the last token
at a place is the only one that ends there and fits the last token where it begins.
Transitions are compiled when first met and kept in a table by the worker; all matches of a block
run through the table in step.

Null texts are empty and have no tokens. Rows are independent, so ties, repeated rows, extra
columns and empty tables need no rule.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candleforge.llm.common import slices
from candleforge.llm.pieces import IS_WHITE

# Character classes. The letters of contractions have classes of their own.
_END, _WHITE, _SPACE, _QUOTE, _OTHER, _NUMBER, _LETTER, _STMD, _RV, _E, _L = range(11)
_CLASSES = 11

# States of the splitter. A white run has its length (one, or more) and its last character.
(
    _START, _WORD, _DIGITS, _MARKS, _APO, _APO_RV, _APO_L,
    _ONE_SPACE, _ONE_WHITE, _MORE_SPACE, _MORE_WHITE,
) = range(11)
_STATES = 11

_HERE, _BEFORE = 1, 2  # emissions: a match begins at this character, at the one before

_CHUNK = 512
#: States of the counter a worker keeps; beyond, it compiles afresh. It bounds memory only.
_KEPT_STATES = 1 << 17


def _transition(state: int, kind: int) -> tuple[int, int]:
    """Next state and emission."""
    letter = kind >= _LETTER
    fresh = (
        _START if kind == _END
        else _ONE_SPACE if kind == _SPACE
        else _ONE_WHITE if kind == _WHITE
        else _APO if kind == _QUOTE
        else _MARKS if kind == _OTHER
        else _DIGITS if kind == _NUMBER
        else _WORD
    )
    if state in (_APO_RV, _APO_L):
        if kind == (_E if state == _APO_RV else _L):
            return _START, 0
        # It was no contraction: the letter before began a word.
        after, emitted = _transition(_WORD, kind)
        return after, emitted | _BEFORE
    if kind == _END:
        return _START, _HERE
    if state == _WORD and letter or state == _DIGITS and kind == _NUMBER:
        return state, 0
    if state in (_MARKS, _APO) and kind in (_OTHER, _QUOTE):
        return _MARKS, 0
    if state == _APO and letter:
        if kind == _STMD:
            return _START, 0
        if kind in (_RV, _L):
            return (_APO_RV if kind == _RV else _APO_L), 0
    if state in (_ONE_SPACE, _ONE_WHITE, _MORE_SPACE, _MORE_WHITE):
        if kind == _SPACE:
            return _MORE_SPACE, 0
        if kind == _WHITE:
            return _MORE_WHITE, 0
        split = _BEFORE if state in (_MORE_SPACE, _MORE_WHITE) else 0
        if state in (_ONE_SPACE, _MORE_SPACE):
            # The space belongs to the match that follows it.
            return (_MARKS if kind == _QUOTE else fresh), split
        return fresh, split | _HERE
    return fresh, _HERE


def _tables() -> tuple[np.ndarray, np.ndarray]:
    pairs = [[_transition(s, k) for k in range(_CLASSES)] for s in range(_STATES)]
    return tuple(np.array([[p[i] for p in row] for row in pairs], np.uint8).ravel() for i in (0, 1))


_NEXT, _EMIT = _tables()


@functools.cache
def _kinds() -> np.ndarray:
    """The class of every code point."""

    def kind(code: int) -> int:
        char = chr(code)
        if IS_WHITE.match(char):
            return _SPACE if char == " " else _WHITE
        group = unicodedata.category(char)[0]
        return _LETTER if group == "L" else _NUMBER if group == "N" else _OTHER

    kinds = np.array([kind(code) for code in range(0x110000)], np.uint8)
    kinds[ord("'")] = _QUOTE
    for letters, own in (("stmd", _STMD), ("rv", _RV), ("e", _E), ("l", _L)):
        kinds[[ord(c) for c in letters]] = own
    return kinds


def match_starts(kinds: np.ndarray) -> np.ndarray:
    """Whether a match begins at each character of a sequence of classes."""
    count = len(kinds)
    chunks = -(-count // _CHUNK)
    padded = np.full(chunks * _CHUNK, _END, np.uint8)
    padded[:count] = kinds
    columns = np.ascontiguousarray(padded.reshape(chunks, _CHUNK).T)

    # State maps: after a few characters most entry states have met, and one lane is enough.
    maps = np.tile(np.arange(_STATES, dtype=np.uint8), (chunks, 1))
    step = 0
    while step < _CHUNK and (step < 16 or step % 16 or (maps != maps[:, :1]).any()):
        maps = _NEXT[maps * _CLASSES + columns[step][:, None]]
        step += 1
    lane = maps[:, 0]
    for column in columns[step:]:
        lane = _NEXT[lane * _CLASSES + column]
    if step < _CHUNK:
        maps[:] = lane[:, None]

    # Prefix scan: map n becomes the composition of maps 0 to n.
    reach = 1
    while reach < chunks:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    state = np.concatenate([[_START], maps[:-1, _START]]).astype(np.uint8)

    emitted = np.empty((_CHUNK, chunks), np.uint8)
    for step, column in enumerate(columns):
        at = state * _CLASSES + column
        emitted[step] = _EMIT[at]
        state = _NEXT[at]
    emitted = emitted.T.ravel()
    starts = emitted[:count] & _HERE > 0
    starts[:-1] |= emitted[1:count] & _BEFORE > 0
    return starts


class Counter:
    """The counting transducer of a vocabulary, compiled as it is used.

    ``merges`` maps a pair of ids to (rank, id of the two together); ``token`` has each id's bytes.
    """

    def __init__(self, token: dict[int, bytes], merges: dict[tuple[int, int], tuple[int, int]]):
        self.token, self.merges = token, merges
        self.id_of = {t: i for i, t in token.items()}
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        self.prefixes = {t[:n] for t in token.values() for n in range(len(t))}
        self.whole = functools.cache(lambda i: self._merged(token[i]) == [i])
        self.fits = functools.cache(lambda a, b: self._merged(token[a] + token[b]) == [a, b])
        self._reset()

    def _reset(self) -> None:
        start = (b"", ((0, None, 0),))
        self.states = [start]
        self.number = {start: 0}
        # Only bytes that occur have a column.
        self.column = np.full(256, -1, np.int64)
        self.bytes: list[int] = []
        self.next = np.full((1 << 13, 32), -1, np.int32)
        self.emit = np.zeros((1 << 13, 32), np.int8)

    def _columns(self, octets: np.ndarray) -> np.ndarray:
        """The table columns of all bytes, new ones added."""
        met = np.flatnonzero(np.bincount(octets, minlength=256))
        for byte in met[self.column[met] < 0].tolist():
            self.column[byte] = len(self.bytes)
            self.bytes.append(byte)
        while len(self.bytes) > self.next.shape[1]:
            more = (len(self.next), 32)
            self.next = np.concatenate([self.next, np.full(more, -1, np.int32)], axis=1)
            self.emit = np.concatenate([self.emit, np.zeros(more, np.int8)], axis=1)
        return self.column[octets]

    def _merged(self, text: bytes) -> list[int]:
        """The encoding of a short string, by its definition."""
        ids = [self.single[b] for b in text]
        while len(ids) > 1:
            known = [self.merges.get(pair, (1 << 60, 0)) for pair in zip(ids, ids[1:])]
            rank, joined = min(known)
            if rank == 1 << 60:
                break
            at = next(n for n, pair in enumerate(known) if pair[0] == rank)
            pair, out, n = (ids[at], ids[at + 1]), [], 0
            while n < len(ids):
                if n + 1 < len(ids) and (ids[n], ids[n + 1]) == pair:
                    out.append(joined)
                    n += 2
                else:
                    out.append(ids[n])
                    n += 1
            ids = out
        return ids

    def _compile(self, state: int, column: int) -> None:
        tail, places = self.states[state]
        grown = tail + bytes([self.bytes[column]])
        last, count = None, 0
        for length, before, so_far in places:
            token = self.id_of.get(grown[len(grown) - 1 - length :])
            if token is not None and self.whole(token):
                if before is None or self.fits(before, token):
                    last, count = token, so_far + 1
                    break
        if last is None:
            raise ValueError("the vocabulary lacks a token that its merges need")
        live = [
            (length + 1, before, so_far - count)
            for length, before, so_far in places
            if grown[len(grown) - 1 - length :] in self.prefixes
        ]
        live.append((0, last, 0))
        key = (grown[len(grown) - live[0][0] :] if live[0][0] else b"", tuple(live))
        target = self.number.get(key)
        if target is None:
            target = self.number[key] = len(self.states)
            self.states.append(key)
            if target == len(self.next):
                more = np.full((1 << 13, self.next.shape[1]), -1, np.int32)
                self.next = np.concatenate([self.next, more])
                self.emit = np.concatenate([self.emit, np.zeros(more.shape, np.int8)])
        self.next[state, column] = target
        self.emit[state, column] = count

    def count(self, octets: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each match, given by its first byte and number of bytes."""
        if len(self.states) > _KEPT_STATES:
            self._reset()
        columns = self._columns(octets)
        order = np.argsort(-lengths, kind="stable")
        first, size = starts[order], lengths[order]
        state = np.zeros(len(order), np.int64)
        tokens = np.zeros(len(order), np.int64)
        active, step = len(order), 0
        while active := int(np.searchsorted(-size[:active], -step)):
            column = columns[first[:active] + step]
            now = state[:active]
            after = self.next[now, column]
            if (missing := after < 0).any():
                for pair in np.unique(now[missing] * 256 + column[missing]).tolist():
                    self._compile(*divmod(pair, 256))
                after = self.next[now, column]
            tokens[:active] += self.emit[now, column]
            state[:active] = after
            step += 1
        out = np.empty_like(tokens)
        out[order] = tokens
        return out


class Tokenizer:
    """Counts tokens as the tokenizers library does for a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = before["type"] == "ByteLevel" and before.get("use_regex", True)
        if not plain or before["add_prefix_space"] or spec["normalizer"] or model["ignore_merges"]:
            raise ValueError("only plain byte-level BPE files are supported")
        octet = _octets()
        ids = {name: bytes(octet[c] for c in name) for name in model["vocab"] if octet.keys() >= set(name)}
        token = {model["vocab"][name]: text for name, text in ids.items()}
        added = [a for a in spec["added_tokens"]]
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("added tokens that strip or match whole words are not supported")
        for a in added:
            token.pop(a["id"], None)
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            vocab = model["vocab"]
            merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        names = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.counter = Counter(token, merges)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text. Strings of added tokens inside a text count as one token."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            split = self.special.split(text) if self.special else [text]
            extra[row] = len(split) - 1
            parts.extend(split)
            owner.extend([row] * len(split))
        # Each part ends with one character that stands for its end.
        joined = "\n".join([*parts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        kinds = _kinds()[codes]
        kinds[ends] = _END
        starts = match_starts(kinds)
        starts[ends] = True
        width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        at = np.cumsum(width) - width
        places = np.flatnonzero(starts)
        first = at[places]
        length = np.diff(first, append=at[-1] + 1 if len(at) else 0)
        real = kinds[places] != _END
        octets = np.frombuffer(joined.encode(), np.uint8)
        tokens = self.counter.count(octets, first[real], length[real])
        part = np.searchsorted(ends, places[real])
        rows = np.asarray(owner, np.int64)[part]
        return extra + np.bincount(rows, tokens, len(texts)).astype(np.int64)


def _octets() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    table = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return table | {chr(256 + n): b for n, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer, with the transitions compiled so far, for all tasks of a worker."""
    return Tokenizer(path)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` but text, and n_bytes (UTF-8) and n_tokens of each text."""
    kept = [f for f in docs.schema if f.name not in ("text", "n_bytes", "n_tokens")]
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    names = [f.name for f in kept] + ["n_bytes", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in slices(batches):
            texts = batch.column("text")
            sizes = pa.compute.binary_length(texts).fill_null(0).cast(pa.int64())
            counts = own.count([t or "" for t in texts.to_pylist()])
            columns = [batch.column(f.name) for f in kept]
            yield pa.record_batch([*columns, sizes, pa.array(counts)], names=names)

    return docs.mapInArrow(run, f"{head}n_bytes long, n_tokens long")
