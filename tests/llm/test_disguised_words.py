"""Disguised spellings of lexicon words are matched, other words with digits and signs are not."""

from __future__ import annotations

import pytest

from candleforge.llm import toxicity

WORDS = ["idiot", "loser", "trash", "stupid", "scum", "asshole", "killing", "zero", "goggles", "dumbass", "lazy"]
LEXICON = toxicity.Lexicon({f" {w} ": 3.0 for w in WORDS} | {" moro": 2.5}, frozenset({"an idiot", "idiot proof"}))


def total(text):
    return sum(LEXICON.hits(toxicity.fold(text)).values())


@pytest.mark.parametrize(
    "spelling",
    "idiot IDIOT 1d10t !d!0t l053r 1oser 7r45h $tupid $7up1d stup!d $cum @sshole @$$h0le k1ll1ng 2er0 6o99les"
    " dumba$$ (1d10t) 1d10t! idiot!! @idiot x!1d10t |azy 1a2y".split(),
)
def test_disguised(spelling):
    assert total(f"you are {spelling} and more") == 3.0


@pytest.mark.parametrize("text", ["", None, "1234 10 5", "a4 b12 mp3 5g", "!!! $5 @ |", "user@example.com", "$100k"])
def test_ordinary(text):
    assert total(text) == 0


def test_beginnings_exceptions_and_weights():
    assert total("m0r0nic") == 2.5
    assert total("an 1d10t") == total("@n idiot") == total("1d10t pr00f") == total("an idiot") == 0
    # One word counts once, whatever its readings.
    assert total("stup!d 1d10t idiot") == 9.0


def test_readings_of_one_long_word_are_few():
    folded = toxicity.fold("a1!" * 100_000)
    assert len(folded.readings) < 300_000 and len(folded.words) == 100_000


def test_disguised_documents_score_as_toxic(spark):
    clean = [f"some clean words about gardens and trees number {n} today" for n in range(40)]
    toxic = [f"you are such an awful idiot and loser number {n} today" for n in range(40)]
    rows = [(n, text) for n, text in enumerate(clean + toxic)]
    rows += [(100, "you are such an awful 1d10t and l053r number 3 today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n >= 40)) for n in range(80)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    lexicon.weights = {t: w for t, w in lexicon.weights.items() if t.strip() in ("idiot", "loser")}
    lexicon._machine = None
    score = {r.doc_id: r.score for r in toxicity.scored(docs, lexicon, "score").collect()}
    assert score[100] == score[40] > score[0]
