"""Secret scans: fixed patterns, and a battery of randomness tests on other runs of characters.

Patterns find assignments of keywords, access keys and long hexadecimal runs. What they leave of a
run of key-like characters is cut at ``=`` (padding stays), and each part with letters and digits,
at least ``LEAST`` long, is tested as a string over its inferred encoding (digits and a-f, base32,
digits and letters of one case, letters and digits, base64): chi-squared uniformity of the
alphabet, in cells of letters that are about as frequent in words; Wald-Wolfowitz runs of lower
case, upper case, digits and marks; and serial correlation of vowels. Fisher's method joins the three
p-values of "this is random" to one statistic. The pieces of a part between its marks (``+/``,
``-_`` or both) are tested too, as names and paths stand before keys; a piece of a secret is not
shown again.

Which strings are secrets is decided against the hypothesis that a string is ordinary. How random
ordinary strings of a length look is learned from the corpus: of every text, some words in a row
are run together with a number, as names and paths are, beside strings made of a fixed list of
words. A string's p-value is the share of ordinary strings of its length class that look as
random. Within each class, over the whole corpus, Benjamini-Hochberg bounds the expected share of
ordinary strings among those shown by ``RATE``; where secrets are rare, fewer short ones are shown. The
statistic is counted in steps of ``STEP`` of its -log10; a step is shown as a whole.

Spans count code points, the end excluded. Null texts are empty and have no spans. Rows are
independent given the cuts, so ties and repeats need no rule; extra columns stay; without any
candidate nothing is shown, and an empty table gives an empty result. A very long text is one
unit of work; a long run is tested on arrays.
"""

from __future__ import annotations

import functools
import math
import operator
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import slices

LEAST = 20
RATE = 0.02
STEP = 0.05
_STEPS = 400  # p-values below 10^-20 share the last step

KINDS = ("assign", "access", "hex", "random")

# The base patterns (fixed values). A keyword may be in either case.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 32 and more are whole runs, as the repetition is greedy.
_HEX = re.compile(r"[0-9a-f]{32,}")
_LEAST_VALUE, _LEAST_ACCESS = 8, 16

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
# "=" ends a part; it belongs to it as padding only where the run ends as well.
_PART = re.compile(r"[A-Za-z0-9+/_-]+(?:=+(?![A-Za-z0-9+/_=-]))?")
_PLAIN = re.compile(r"[A-Za-z0-9]+=*")
_BETWEEN = [re.compile(r"[A-Za-z0-9_-]+=*"), re.compile(r"[A-Za-z0-9+/]+=*")]

# Letters from the most frequent in words to the least (fixed value).
_FREQUENT = "etaoinsrhldcumfpgwybvkxjqz"
_VOWELS = "aeiouyAEIOUY"
_DIGITS = "0123456789"
_BOTH = "".join(a + a.upper() for a in _FREQUENT)

# Alphabets from the narrowest (fixed values); digits come before or after all letters.
_ALPHABETS = [
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _FREQUENT.upper() + "234567"),
    ("base32 lower", _FREQUENT + "234567"),
    ("base36", _FREQUENT + _DIGITS),
    ("BASE36", _FREQUENT.upper() + _DIGITS),
    ("base62", _BOTH + _DIGITS),
    ("base64", _BOTH + _DIGITS + "+/"),
    ("base64url", _BOTH + _DIGITS + "-_"),
]


# For each byte: lower case, upper case, digit or mark; and whether it is a vowel.
_KINDS = bytes(
    0 if chr(b).islower() else 1 if chr(b).isupper() else 2 if chr(b).isdigit() else 3 for b in range(256)
)
_IS_VOWEL = bytes(int(chr(b) in _VOWELS) for b in range(256))


@functools.cache
def _cells(letters: str, cells: int) -> tuple[bytes, list[int]]:
    """The cell of each byte, and how many letters each cell has."""
    places = [n * cells // len(letters) for n in range(len(letters))]
    return bytes.maketrans(letters.encode(), bytes(places)), [places.count(n) for n in range(cells)]


# Words that ordinary strings are made of where the corpus has few (fixed values).
_ORDINARY = (
    "get user account by id service config value data file path index version test release build "
    "main server client handler request response cache table query update delete insert session "
    "manager factory controller view model string number array buffer stream reader writer parse "
    "format output input error message status code name type list item group order date time year "
    "month project example module package library install windows linux image video report record"
).split()
_ENDS = [20, 23, 26, 30, 34, 40, 46, 54, 64, 76, 90, 110, 130]  # lengths of ordinary strings
_FIXED = 300  # of them made of the fixed words, for each length
# Whole words alone, not letters of a key.
_WORDS = re.compile(r"""(?<![^\s.,;:!?"'()])[A-Za-z]{2,14}(?![^\s.,;:!?"'()])""")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if len(m.group(2)) >= _LEAST_VALUE:
                found.append((*m.span(), "assign"))
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= _LEAST_ACCESS:
            found.append((*m.span(), "access"))
    found.extend((*m.span(), "hex") for m in _HEX.finditer(text))
    return found


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail by the Wilson-Hilferty approximation."""
    if df < 1:
        return 1.0
    spread = 2 / (9 * df)
    z = ((x / df) ** (1 / 3) - 1 + spread) / math.sqrt(spread)
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(value: str) -> float | None:
    """The joint p-value of "random over its encoding", None for no known encoding."""
    text = value.rstrip("=").encode("ascii")
    count = len(text)
    letters = next((own for _, own in _ALPHABETS if not text.translate(None, own.encode())), None)
    if letters is None or count < 2:
        return None
    # Cells of equal width, so that each expects about five characters.
    cells = max(2, min(len(letters), count // 5))
    table, widths = _cells(letters, cells)
    placed, chi2 = text.translate(table), 0.0
    for cell, width in enumerate(widths):
        expected = count * width / len(letters)
        chi2 += (placed.count(cell) - expected) ** 2 / expected
    p_uniform = _chi2_tail(chi2, cells - 1)

    kinds = text.translate(_KINDS)
    sizes = [kinds.count(kind) for kind in range(4)]
    runs = 1 + sum(map(operator.ne, kinds, kinds[1:]))
    squares, cubes = sum(n * n for n in sizes), sum(n**3 for n in sizes)
    mean = (count * (count + 1) - squares) / count
    variance = (squares * (squares + count * (count + 1)) - 2 * count * cubes - count**3) / (
        count * count * (count - 1)
    )
    p_runs = _normal_tail((runs - mean) / math.sqrt(variance)) if variance > 1e-9 else 1.0

    vowels = text.translate(_IS_VOWEL)
    whole, both = vowels.count(1), sum(map(operator.and_, vowels, vowels[1:]))
    share = whole / count
    if power := whole * (1 - share):
        neighbours = both - share * (2 * whole - vowels[0] - vowels[-1]) + (count - 1) * share * share
        p_serial = _normal_tail((neighbours / power + 1 / count) * math.sqrt(count))
    else:
        p_serial = 1.0

    half = -sum(math.log(max(p, 1e-300)) for p in (p_uniform, p_runs, p_serial))
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def _step(p: float) -> int:
    return min(_STEPS, int(-math.log10(max(p, 1e-300)) / STEP))


def length_class(size: int) -> int:
    """Classes grow by a fifth."""
    return int(4 * math.log2(size))


def ordinary(words: Iterable[str], number: int, size: int) -> str | None:
    """Words run together to about a length, in one of six styles, with one number or two."""
    style, number = number % 6, number // 6
    mark = ("", "", "_", "/", "-", "/")[style]
    # A number stands at the end, behind the first word, or in both places.
    early, late, number = number % 3 > 0, number % 3 < 2, number // 3
    made = ""
    for n, word in enumerate(words):
        made += mark if made else ""
        made += word.capitalize() if style == 1 else word[:5] if style == 5 else word
        if early and not n:
            made += str(number % 100)
        if len(made) >= size - 2:
            return made[: size + 8] + (str(number // 100 % 3000) if late or not early else "")
    return None


def _ordinary_of(text: str) -> str | None:
    """An ordinary string of a text: some of its words from a place that its hash gives."""
    number = zlib.crc32(text.encode())
    words = (m.group() for m in _WORDS.finditer(text, number % len(text)))
    return ordinary(words, number >> 4, _ENDS[number % len(_ENDS)])


def _ordinary_steps() -> Counter:
    """Steps of strings of the fixed words, by length class."""
    made, counts = random.Random(0), Counter()
    for size in _ENDS:
        for _ in range(_FIXED):
            value = ordinary(iter(lambda: made.choice(_ORDINARY), None), made.randrange(1 << 28), size)
            counts[length_class(len(value)), _step(randomness(value))] += 1
    return counts


def _strings(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The strings to test in a stretch of key-like characters, an outer one before its pieces."""
    found = set()
    for m in _PART.finditer(text, start, end):
        if m.end() - m.start() < LEAST:
            continue
        value = m.group()
        slashes, dashes = "+" in value or "/" in value, "-" in value or "_" in value
        forms = [_PLAIN] if slashes or dashes else []
        if slashes and dashes:
            forms += _BETWEEN  # no encoding has both
        else:
            found.add(m.span())
        for form in forms:
            found.update(p.span() for p in form.finditer(text, *m.span()) if p.end() - p.start() >= LEAST)
    return sorted(found, key=lambda s: (s[0], -s[1]))


def candidates(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, int, int]]:
    """start, end, length class and step of the p-value of each string the patterns left."""
    taken, met, reach = sorted(taken), 0, 0
    for m in _RUN.finditer(text):
        at, last = m.span()
        # Runs come in order, so the furthest end of the spans begun so far tells what is taken.
        stretches, at = [], max(at, reach)
        while met < len(taken) and taken[met][0] < last:
            if taken[met][0] > at:
                stretches.append((at, taken[met][0]))
            reach = max(reach, taken[met][1])
            at, met = max(at, reach), met + 1
        if at < last:
            stretches.append((at, last))
        for stretch in stretches:
            for start, end in _strings(text, *stretch):
                value = text[start:end]
                if not any(map(str.isalpha, value)) or not any(map(str.isdigit, value)):
                    continue
                p = randomness(value)
                if p is not None:
                    yield start, end, length_class(end - start), _step(p)


def cuts(docs: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each length class the least step whose strings are taken for ordinary.

    Every text is read; a task reports counts by class and step, at most a few thousand rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    counts.update((True, *c[2:]) for c in candidates(text, base_spans(text)))
                    plain = _ordinary_of(text)
                    if plain is not None and (p := randomness(plain)) is not None:
                        counts[False, length_class(len(plain)), _step(p)] += 1
        yield pa.record_batch(
            {
                "met": pa.array([k[0] for k in counts], pa.bool_()),
                "size": pa.array([k[1] for k in counts], pa.int32()),
                "step": pa.array([k[2] for k in counts], pa.int32()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    parts = docs.select("text").mapInArrow(run, "met boolean, size int, step int, n long")
    met, plain = {}, _ordinary_steps()
    for row in parts.groupBy("met", "size", "step").agg(F.sum("n").alias("n")).collect():
        if row["met"]:
            met.setdefault(row["size"], Counter())[row["step"]] += row["n"]
        else:
            plain[row["size"], row["step"]] += row["n"]
    return {size: _cut(steps, _nearest(plain, size), rate) for size, steps in met.items()}


def _nearest(plain: Counter, size: int) -> Counter:
    """The steps of the ordinary strings of a length class, or of the next class that has some.

    Longer ordinary strings look less random, so a shorter class is the safe one."""
    sizes = sorted({s for s, _ in plain})
    own = max((s for s in sizes if s <= size), default=sizes[0])
    return Counter({step: n for (s, step), n in plain.items() if s == own})


def _cut(steps: Counter, plain: Counter, rate: float) -> int:
    """Benjamini-Hochberg over steps: behind the last with p <= rate * rank / all, 0 for none."""
    total, ordinary_total = sum(steps.values()), sum(plain.values())
    rank = as_random = cut = 0
    for step in range(_STEPS + 1):
        rank += steps[step]
        as_random += plain[step]
        if steps[step] and (1 + as_random) / (1 + ordinary_total) <= rate * rank / total:
            cut = step + 1
    return cut


def spans(text: str | None, cut: dict[int, int]) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind."""
    if not text:
        return []
    found, reach = base_spans(text), 0
    secret = []
    for start, end, size, step in candidates(text, found):
        # Strings come by start, outer ones first; one that ends no later is a piece of a secret.
        if end > reach and step < cut.get(size, _STEPS + 1):
            secret.append((start, end, "random"))
            reach = end
    return sorted(found + secret, key=lambda s: (s[0], KINDS.index(s[2])))


_SPAN = "array<struct<kind: string, start: long, end: long>>"
_SPAN_TYPE = pa.list_(pa.struct({"kind": pa.string(), "start": pa.int64(), "end": pa.int64()}))


def scan(docs: DataFrame, cut: dict[int, int], column: str = "secrets") -> DataFrame:
    """The columns of ``docs`` but text, and the spans of each whole text."""
    kept = [f for f in docs.schema if f.name not in ("text", column)]
    described = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                [{"kind": k, "start": a, "end": b} for a, b, k in spans(t, cut)]
                for t in batch.column("text").to_pylist()
            ]
            columns = [batch.column(f.name) for f in kept]
            yield pa.record_batch(
                [*columns, pa.array(found, _SPAN_TYPE)], names=[f.name for f in kept] + [column]
            )

    return docs.mapInArrow(run, f"{described}`{column}` {_SPAN}")


def redacted(text: str, found: list[tuple[int, int, str]], mark: str) -> str:
    parts, at = [], 0
    for start, end, _ in found:
        if start > at or not parts:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, cut: dict[int, int], mark: str = "[SECRET]") -> DataFrame:
    """The documents with each secret replaced by ``mark``; all others as they are.

    n_chars, if there is such a whole-number column, follows a changed text.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            new = {"text": batch.column("text").to_pylist()}
            if "n_chars" in schema.names:
                new["n_chars"] = batch.column("n_chars").to_pylist()
            for n, text in enumerate(new["text"]):
                if found := spans(text, cut):
                    new["text"][n] = redacted(text, found, mark)
                    if "n_chars" in new:
                        new["n_chars"][n] = len(new["text"][n])
            for name, values in new.items():
                at = batch.schema.names.index(name)
                batch = batch.set_column(at, name, pa.array(values, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, schema)
