"""Plain versions of the operators' contracts, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    own = words(text)
    windows = Counter(tuple(own[n : n + 3]) for n in range(len(own) - 2))
    inside = {n + k for n in range(len(own) - 2) for k in range(3) if windows[tuple(own[n : n + 3])] > 1}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    chars = sum(map(len, own))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(own) < 50 or 100 * len(inside) > 50 * len(own)
    return len(own), chars, symbols, repeated, len(inside), failed


def secrets(text):
    text, found = text or "", []
    key = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(key, text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, "hex", m.end()))
    found.sort()
    shown = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)
    counts = Counter(kind for _, _, kind, _ in found)
    return counts["assign"], counts["access"], counts["hex"], sha(shown), shown


def folded_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def overlap(text, items):
    own = folded_words(text)
    hit, names = set(), set()
    places: dict[int, dict[tuple, list[int]]] = {}
    for name, item in items:
        whole = folded_words(item)
        size = min(13, len(whole))
        if not size:
            continue
        if size not in places:
            places[size] = {}
            for n in range(len(own) - size + 1):
                places[size].setdefault(tuple(own[n : n + size]), []).append(n)
        for n in range(len(whole) - size + 1):
            for at in places[size].get(tuple(whole[n : n + size]), ()):
                hit.update(range(at, at + size))
                names.add(str(name))
    contaminated = len(hit) > 0 and 20 * len(hit) >= len(own)
    return len(own), len(hit), len(names), sha(",".join(sorted(names))), contaminated


def fingerprint(text):
    own = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return 0
    shingles = [" ".join(own[n : n + 3]) for n in range(max(len(own) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable, for (id, fingerprint) rows, by comparing all distinct pairs."""
    least: dict[int, int | None] = {}
    for doc_id, fp in prints:
        known = least.get(fp)
        least[fp] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    distinct = list(least)
    root = {fp: fp for fp in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(distinct):
        for b in distinct[:n]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    best: dict[int, int | None] = {}
    for fp in distinct:
        r, own = find(fp), least[fp]
        best[r] = own if best.get(r) is None else best[r] if own is None else min(best[r], own)
    return [(doc_id, f"{fp:016x}", best[find(fp)]) for doc_id, fp in prints]


def stream(texts, tokenizer):
    """start, n_tokens and crc32 of each text, in the given order."""
    rows, start = [], 0
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        rows.append((start, len(ids), crc))
        start += len(ids)
    return rows


def conversation(turns):
    """n_turns, digest of all turns, loss_chars and digest of the assistant texts."""
    ordered = [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: (x[0], x[1] or "", x[2] or ""))]
    loss = "".join(t for r, t in ordered if r == "assistant")
    return len(ordered), sha("".join(f"{r}\n{t}\n" for r, t in ordered)), len(loss), sha(loss)
