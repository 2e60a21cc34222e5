"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps look-alike letters to plain ones. A word with digits or signs and at least one letter is
matched as it is and by its unmasked readings, in which digits and signs stand for letters (1, ! and |
for i or for l, 6 for g or for b, the same throughout a word; signs at its ends also left out), so
disguised spellings meet the lexicon; a reading counts only if it is in the lexicon. The lexicon is learned from labelled texts: words, and beginnings of
words of ``STEM`` characters, whose share of toxic documents is higher than chance allows; their
weight is the log odds. An exception phrase (a lexicon word with the word before or after it) that
is at home in other documents cancels the weights of its words. A document's total weight and
its weight per word go into a logistic curve, which gives the score.

Lexicon and curve are fitted on at most ``PER_CLASS`` documents of each label. A text without words,
and a null text, has no weight; its score is that of the curve at zero. Without labelled rows of
both kinds the score is 0. Rows with one doc_id are scored one by one; of contradicting labels of
one document the higher counts. Extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.llm.common import bounded_sample, slices, stored

#: Labelled documents of each class that the lexicon and the curve are fitted on.
PER_CLASS = 10_000
#: Lengths of word beginnings that may enter the lexicon.
STEM = range(4, 9)
#: Least log-likelihood ratio and least log odds of an entry.
LEAST_RATIO, LEAST_WEIGHT = 18.0, 2.0
THRESHOLD = 0.7

# Look-alikes of Latin letters in Cyrillic and Greek (fixed values).
_LIKE = str.maketrans(
    "абвгеёзіїјкмнорсѕтухѡԁԛԝһӏαβγεηικνορτυχω",
    "abbreesiijkmhopcstyxwdqwhlabyenikvoptuxw",
)
# Digits and signs that stand for letters, in two readings (fixed values).
_SIGNS = "@$!|"
_READINGS = [
    str.maketrans("0123456789@$!|", "oizeasgtbgasii"),
    str.maketrans("0123456789@$!|", "olzeasbtbgasll"),
]

_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"(?:[^\W_]|[@$!|])+")


@dataclass
class Folded:
    """The words of a text in plain lower-case letters, and unmasked readings.

    A reading is (first word, word after it, text).
    """

    words: list[str] = field(default_factory=list)
    readings: list[tuple[int, int, str]] = field(default_factory=list)

    def forms(self) -> set[str]:
        return {*self.words, *(text for _, _, text in self.readings)}

    def phrases(self, matched: Iterable[tuple[int, int, str]]) -> Iterator[list[str]]:
        """For each matched form, it with each form of the word before, and of the word after it."""
        begins, ends = {}, {}
        for first, after, text in self.readings:
            begins.setdefault(first, []).append(text)
            ends.setdefault(after, []).append(text)
        for first, after, text in matched:
            before = [*self.words[max(first - 1, 0) : first], *(ends.get(first, ()))]
            behind = [*self.words[after : after + 1], *(begins.get(after, ()))]
            yield [*(f"{w} {text}" for w in before), *(f"{text} {w}" for w in behind)]


def fold(text: str | None) -> Folded:
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower().translate(_LIKE)
    found = Folded()
    words = found.words
    for token in _TOKEN.findall(text):
        if token.isalpha():
            words.append(token)
            continue
        first = len(words)
        words.extend(_WORD.findall(token))
        if any(map(str.isalpha, token)):
            _unmask(token, first, found)
    return found


def _unmask(token: str, first: int, found: Folded) -> None:
    """Add the readings of a token, and of each of its words, that are not the words themselves."""
    left, right = token.lstrip(_SIGNS), token.rstrip(_SIGNS)
    whole = {token, left, right, left.rstrip(_SIGNS)}
    after = len(found.words)
    parts = [(first, after, form) for form in whole]
    if after > first + 1:
        own = enumerate(found.words[first:], first)
        parts += [(n, n + 1, w) for n, w in own if any(map(str.isalpha, w))]
    known = {(n, n + 1, w) for n, w in enumerate(found.words[first:], first)}
    made = {(a, b, form.translate(table)) for a, b, form in parts for table in _READINGS}
    found.readings.extend(sorted(made - known))


def _terms(word: str) -> Iterator[str]:
    """Lexicon entries a word could match: itself, and its beginnings."""
    yield f" {word} "
    for size in STEM:
        if size >= len(word):
            break
        yield f" {word[:size]}"


@dataclass
class Lexicon:
    """Entries are `` word `` or `` beginning``; exceptions are two words."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] | None = None
    _machine: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_machine": None}

    def machine(self):
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                self._machine.add_word(term, (term, weight))
            if len(self._machine):
                self._machine.make_automaton()
        return self._machine

    def matches(self, folded: Folded) -> dict[tuple[int, int, str], float]:
        """Weight by matched form (first word, word after it, text), exceptions left out.

        Words and unmasked readings are searched together; a place tells which form was met.
        """
        machine = self.machine()
        if not folded.words or not len(machine):
            return {}
        plain = [(n, n + 1, word) for n, word in enumerate(folded.words)]
        forms = plain + folded.readings
        best: dict[int, float] = {}
        for end, (term, weight) in machine.iter(f" {' '.join([f[2] for f in forms])} "):
            place = end - len(term) + 1
            best[place] = max(weight, best.get(place, 0.0))
        if not best:
            return {}
        starts = list(itertools.accumulate((len(f[2]) + 1 for f in forms), initial=0))
        found = {forms[bisect.bisect_left(starts, place)]: weight for place, weight in best.items()}
        if self.exceptions:
            near = zip(list(found), folded.phrases(list(found)))
            return {form: found[form] for form, own in near if self.exceptions.isdisjoint(own)}
        return found

    def hits(self, folded: Folded) -> dict[int, float]:
        """The greatest weight by number of each matched word, exceptions left out."""
        best: dict[int, float] = {}
        for (n, _, _), weight in self.matches(folded).items():
            best[n] = max(weight, best.get(n, 0.0))
        return best

    def features(self, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        total = sum(self.hits(folded).values())
        return math.log1p(total), math.log1p(100 * total / max(len(folded.words), 1))

    def score(self, features: tuple[float, float]) -> float:
        if self.curve is None:
            return 0.0
        a, b, c = self.curve
        z = a + b * features[0] + c * features[1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _counted(rows: DataFrame, terms_of) -> DataFrame:
    """term, toxic and clean: documents of the sample that hold a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()
        for batch in slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[toxic].update(terms_of(fold(text)))
        names = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.record_batch(
                {"term": pa.array(part, pa.string())}
                | {n: pa.array([counts[k][t] for t in part], pa.int64()) for n, k in (("toxic", 1), ("clean", 0))}
            )

    parts = rows.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _ratio(toxic: int, clean: int, sizes: dict[int, int]) -> tuple[float, float]:
    """Log-likelihood ratio against equal shares, and log odds."""
    share = sizes[1] / (sizes[0] + sizes[1])
    total = toxic + clean
    terms = [(toxic, total * share), (clean, total * (1 - share))]
    ratio = 2 * sum(o * math.log(o / e) for o, e in terms if o)
    odds = math.log((toxic + 0.5) / (sizes[1] + 1)) - math.log((clean + 0.5) / (sizes[0] + 1))
    return ratio, odds


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """text, toxic (0 or 1) and share of at most ``per_class`` labelled documents of each class."""
    marked = labels.filter("toxic in (0, 1) and doc_id is not null")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = bounded_sample(marked, "toxic", per_class)
    # At most 2 * per_class rows of two numbers, so the texts need no shuffle.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # A doc_id on many rows counts once: of its texts that with the least hash.
    mark = F.xxhash64("text")
    least = found.groupBy("doc_id").agg(F.min(mark).alias("__mark"))
    one = found.withColumn("__mark", mark).join(F.broadcast(least), ["doc_id", "__mark"], "left_semi")
    return one.select("doc_id", "text", "toxic").distinct().select("text", "toxic")


def fit(rows: DataFrame, prior: float) -> Lexicon:
    """Learn from rows (text, toxic); ``prior`` is the share of toxic rows to assume."""
    # Stored, not cached: whole texts would fill the executors' memory.
    rows = stored(rows, "toxicity-sample")
    sizes = {0: 0, 1: 0} | {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not sizes[0] or not sizes[1]:
        return Lexicon()

    def terms(folded: Folded) -> set[str]:
        return {t for w in folded.forms() for t in _terms(w)}

    # As many as the bounded sample has terms that three toxic documents share.
    shared = _counted(rows.filter("toxic = 1"), terms).filter("toxic >= 3").select("term")
    asked = frozenset(r["term"] for r in shared.collect())
    counts = _counted(rows, lambda folded: terms(folded) & asked).collect()
    rated = ((r["term"], _ratio(r["toxic"], r["clean"], sizes)) for r in counts)
    weights = {t: w for t, (g, w) in rated if g >= LEAST_RATIO and w >= LEAST_WEIGHT}
    lexicon = Lexicon(weights)

    def phrases(folded: Folded) -> set[str]:
        return {p for own in folded.phrases(list(lexicon.matches(folded))) for p in own}

    met = _counted(rows, phrases).filter("clean >= 3")
    excused = []
    for row in met.toLocalIterator():
        ratio, odds = _ratio(row["toxic"], row["clean"], sizes)
        if odds < 0 and ratio >= LEAST_RATIO / 2:
            excused.append(row["term"])
    lexicon.exceptions = frozenset(excused)
    lexicon.curve = _curve(*_features(rows, lexicon), prior)
    return lexicon


def _features(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [lexicon.features(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[n] for f in found], pa.float64()) for n in (0, 1)]
            yield pa.record_batch([*columns, batch.column("toxic")], names=["a", "b", "toxic"])

    got = rows.mapInArrow(run, "a double, b double, toxic int").toArrow()  # 2 * PER_CLASS rows
    x = np.column_stack([got.column("a").to_numpy(), got.column("b").to_numpy()])
    return x, got.column("toxic").to_numpy()


def _curve(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, lightly held to zero, weighted to the prior."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, prior / max((y == 1).mean(), 1e-9), (1 - prior) / max((y == 0).mean(), 1e-9))
    beta = np.zeros(3)
    hold = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(
            (x * (weight * p * (1 - p))[:, None]).T @ x + hold, x.T @ (weight * (y - p)) - hold @ beta
        )
        beta += step
        if abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Lexicon:
    """The lexicon from all given labels of the documents."""
    usable = labels.filter("toxic in (0, 1)")
    prior = usable.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if prior is None:
        return Lexicon()
    return fit(training_rows(docs, labels, per_class), prior)


def scored(docs: DataFrame, lexicon: Lexicon, column: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text."""
    kept = [f for f in docs.schema if f.name != column]
    described = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [lexicon.score(lexicon.features(t)) for t in batch.column("text").to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            yield pa.record_batch(
                [*columns, pa.array(scores, pa.float64())], names=[f.name for f in kept] + [column]
            )

    return docs.mapInArrow(run, f"{described}, `{column}` double")
