"""Encoding texts piece by piece, so that each distinct piece is tokenized once.

Byte-level BPE of this family never merges across the start of a run of white space that
follows other characters, nor from a letter on to a mark: there the pre-tokenizer always begins a new
match, and nothing before it depends on what comes after. A text is cut there, and its ids are
those of its pieces in order. Arrow cuts all texts of a slice and numbers their distinct pieces;
the ids of all places are then gathered from those of the distinct ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The characters with Unicode's White_Space property (fixed values).
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"

#: Matches one white-space character.
IS_WHITE = re.compile(f"[{WHITE}]")

_PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

# Where none of these occurs, each space and each new line stands alone.
_RUN = f"[{WHITE}][ \\n]|\\n[{WHITE}]"
# Texts that hold the cutting mark, or might hold a special token, are cut at white space alone.
_CUT = "\0"
_STRANGE = "\\x00|<\\|"

_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_WORD_END = f"([{_LETTERS}])([!-/:-@\\[-`{{-~])"

#: Pieces a worker remembers at least and, twice this, at most. It bounds memory only: what was
#: not met since the last turn-over is forgotten and encoded again when it comes up.
REMEMBERED = 250_000


def cut_all(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts (none null) in order, and the number of each one's text."""
    strange = pc.match_substring_regex(texts, _STRANGE).to_numpy(zero_copy_only=False)
    runs = pc.match_substring_regex(texts, _RUN).to_numpy(zero_copy_only=False) & ~strange
    rows = np.flatnonzero(~strange & ~runs)
    plain = texts.take(pa.array(rows))
    plain = pc.replace_substring(plain, " ", f"{_CUT} ")
    # A new line alone is a match of its own.
    marked = [pc.replace_substring(plain, "\n", f"{_CUT}\n{_CUT}")]
    of_row = [rows]
    if runs.any():
        rows = np.flatnonzero(runs)
        found = [_CUT.join(_PIECE.findall(t)) for t in texts.take(pa.array(rows)).to_pylist()]
        marked.append(pa.array(found, texts.type))
        of_row.append(rows)
    # Rows have bounded text, so their parts fit one array.
    marked = pc.replace_substring_regex(pa.concat_arrays(marked), _WORD_END, f"\\1{_CUT}\\2")
    lists = pc.split_pattern(marked, _CUT)
    pieces = pc.list_flatten(lists)
    owners = np.concatenate(of_row)[pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)]
    if strange.any():
        rows = np.flatnonzero(strange)
        found = [_PIECE.findall(t) for t in texts.take(pa.array(rows)).to_pylist()]
        pieces = pa.concat_arrays([pieces, pa.array([p for own in found for p in own], texts.type)])
        owners = np.concatenate([owners, np.repeat(rows, [len(own) for own in found])])
    if len(of_row) > 1 or strange.any():
        order = np.argsort(owners, kind="stable")
        pieces, owners = pieces.take(pa.array(order)), owners[order]
    return pieces, owners


def cut(text: str) -> list[str]:
    """The pieces of one text."""
    return cut_all(pa.array([text], pa.string()))[0].to_pylist()


class Pieces:
    """The ids of texts from those of their distinct pieces.

    ``encode_all`` gives them for a list of distinct pieces, packed as integers of ``kind``.
    """

    def __init__(self, encode_all: Callable[[list[str]], list[bytes]], kind: np.dtype):
        self.encode_all, self.kind = encode_all, kind
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _packed(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, pieces))
        fresh = []
        for n, packed in enumerate(found):
            if packed is None:
                piece = pieces[n]
                if (packed := older.get(piece)) is None:
                    fresh.append(n)
                else:
                    found[n] = known[piece] = packed
        for n, packed in zip(fresh, self.encode_all([pieces[n] for n in fresh])):
            found[n] = known[pieces[n]] = packed
        return found

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none null) in order, and how many each text has."""
        pieces, owners = cut_all(texts)
        coded = pieces.dictionary_encode()
        packed = self._packed(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.kind.itemsize
        flat = np.frombuffer(b"".join(packed), self.kind)
        place = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[place]
        ends = np.cumsum(lengths)
        # Id k of a piece is k places behind the first of its kind.
        begins = (np.cumsum(sizes) - sizes)[place] - (ends - lengths)
        ids = flat[np.repeat(begins, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        counts = np.bincount(owners, lengths, len(texts)).astype(np.int64)
        return ids, counts
