"""The search for benchmark passages: longest matches of all documents, in bounded memory."""

from __future__ import annotations

import random
import tracemalloc

import pytest

from candleforge.llm import decontaminate


def scanned(texts, items, window=decontaminate.WINDOW):
    words = [decontaminate.words_of(t) for t in texts]
    rows = [decontaminate._Row(len(w), None, None, (0, None, None)) for w in words]
    decontaminate._scan(words, rows, decontaminate.Benchmark(items, window))
    return rows


def plain(text, items, window):
    """Hit places, names, the words of the longest match, and all (place, name) of such matches."""
    own, hit, names, best = decontaminate.words_of(text), set(), set(), {}
    for name, item in items:
        whole = decontaminate.words_of(item)
        need = min(window, len(whole))
        for a in range(len(own)):
            for b in range(len(whole) if len(whole) >= window else min(len(whole), 1)):
                size = 0
                while a + size < len(own) and b + size < len(whole) and own[a + size] == whole[b + size]:
                    size += 1
                if size >= need:
                    hit.update(range(a, a + size))
                    names.add(name)
                    best.setdefault(size, set()).add((a, name))
    most = max(best, default=0)
    return hit, names, most, best.get(most, set())


@pytest.mark.parametrize("seed", range(40))
def test_all_matches_against_a_plain_search(seed, monkeypatch):
    made = random.Random(seed)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", made.choice([7, 50, 1 << 19]))
    window, letters = made.choice([2, 3, 5]), "abc"[: made.choice([1, 2, 3])] + "xyz"
    texts = [[made.choice(letters) for _ in range(made.randrange(60))] for _ in range(6)]
    items = []
    for n in range(6):
        source = made.choice(texts)
        at = made.randrange(len(source) + 1)
        own = source[at : at + made.randrange(40)] + [made.choice(letters) for _ in range(made.randrange(4))]
        items.append((f"i{n % 5}", " ".join(own)))
    # Partial copies of one item in several documents.
    texts += [items[0][1].split()[:k] for k in (4, 9, 20)]
    texts = [" ".join(t) for t in texts]
    for text, row in zip(texts, scanned(texts, items, window)):
        hit, names, most, where = plain(text, items, window)
        assert set(row.hit.nonzero()[0].tolist()) == hit
        assert row.items == names
        assert row.longest[0] == most
        assert not most or row.longest[1:] in where


def peak(texts, items):
    tracemalloc.start()
    rows = scanned(texts, items)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return rows, most


def test_equal_words_take_bounded_memory():
    rows, most = peak(["0 " * 5_000], [("grid", "0 " * 100)])
    assert rows[0].longest[0] == 100 and rows[0].hit.all()
    assert most < 60 << 20


def test_long_copies_take_bounded_memory():
    item = " ".join(f"w{n}" for n in range(3_000))
    part = " ".join(item.split()[1_000:2_000])
    rows, most = peak([item] * 3 + [part], [("long", item)])
    assert [r.longest for r in rows] == [(3_000, 0, "long")] * 3 + [(1_000, 0, "long")]
    assert most < 60 << 20
