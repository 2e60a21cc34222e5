"""Learned operators: held-out accuracy of the queries, and scores against plain versions."""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from candleforge.llm import language, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"
# Toxic documents are few: more of them are needed to learn from.
TOXIC_DIR = "/root/testdata/sf0.1"


def given(name, folder=SF_DIR):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_toxicity_on_held_out_labels(spark):
    rows = queries.QUERIES["op3_toxicity"](spark, TOXIC_DIR).collect()
    assert len(rows) == len(given("documents", TOXIC_DIR))
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    toxic = {x["doc_id"]: x["toxic"] for x in given("labels", TOXIC_DIR)}
    held = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    found, wanted = sum(t and p for t, p in held), sum(t for t, _ in held)
    assert wanted >= 100 and found >= 0.9 * wanted
    assert sum(p and not t for t, p in held) <= 0.01 * len(held)


def plain_matches(lexicon, folded):
    """Greatest weight of each word or reading, by trying every entry."""
    forms = [(n, n + 1, w) for n, w in enumerate(folded.words)] + folded.readings
    found = {}
    for form in forms:
        for term, weight in lexicon.weights.items():
            if term.endswith(" "):
                met = form[2] == term[1:-1]
            else:
                met = form[2].startswith(term[1:])
            if met:
                found[form] = max(weight, found.get(form, 0.0))
    kept = {}
    for form, weight in found.items():
        before = {f[2] for f in forms if f[1] == form[0]}
        behind = {f[2] for f in forms if f[0] == form[1]}
        phrases = {f"{w} {form[2]}" for w in before} | {f"{form[2]} {w}" for w in behind}
        if not phrases & lexicon.exceptions:
            kept[form] = weight
    return kept


@pytest.mark.parametrize("seed", range(6))
def test_matches_are_those_of_every_entry(seed):
    made = random.Random(seed)
    lexicon = toxicity.Lexicon(
        {" idiot ": 3.0, " idio": 2.5, " trash": 2.0, " as ": 4.0, " loser ": 2.2, " lose": 2.1},
        frozenset({"white trash", "idiot proof", "as you"}),
    )
    words = "idiot idiots 1d10t tr@sh $trash trashy as a5 white wh1te proof you los3r l0$er lose closer id-iot a_s !diot".split()
    for _ in range(300):
        text = " ".join(made.choice(words) for _ in range(made.randint(0, 12)))
        folded = toxicity.fold(text)
        assert lexicon.matches(folded) == plain_matches(lexicon, folded), text


def plain_grams(text):
    clean = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    if not any(unicodedata.category(c)[0] == "L" for c in clean):
        return []
    counts = Counter()
    padded = f" {' '.join(clean.split())} "
    for size in (1, 2, 3):
        for n in range(len(padded) - size + 1):
            gram = padded[n : n + size]
            if gram != " " and not (size == 3 and gram[1] == " "):
                counts[gram] += 1
    return sorted(counts, key=lambda g: (-counts[g], tuple(map(ord, "\0" * (3 - len(g)) + g))))


def plain_language(text, profiles):
    own = plain_grams(text)[: language.DOCUMENT]
    if not own or not profiles:
        return "und"
    away = {}
    for name, ranks in profiles.items():
        away[name] = sum(abs(ranks[g] - n) if g in ranks else language.PROFILE for n, g in enumerate(own))
    return min(sorted(away), key=away.get)


def test_language_is_that_of_the_nearest_profile(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = language.profiles(docs.filter("doc_id % 5 != 0"))
    mask = (1 << 21) - 1
    profiles = {
        name: {
            "".join(chr(c) for s in (42, 21, 0) if (c := int(g) >> s & mask)): n for n, g in enumerate(grams)
        }
        for name, grams in found.items()
    }
    own = language.Profiles(found)
    texts = [d["text"] for d in given("documents")[:150]] + ["", None, "123 !", "́́", "x́", "م", "a"]
    for text in texts:
        assert own.predict(text)[0] == plain_language(text, profiles), (text or "")[:50]


def test_language_on_held_out_documents(spark):
    rows = queries.QUERIES["op5_language"](spark, SF_DIR).collect()
    docs = {d["doc_id"]: d for d in given("documents")}
    assert len(rows) == len(docs)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [(docs[r.doc_id]["lang"], r.lang_pred) for r in rows if r.held_out and docs[r.doc_id]["lang"]]
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.97 * len(held)


def test_marks_alone_have_no_language(spark):
    docs = spark.createDataFrame(
        [(n, t, "en") for n, t in enumerate(["a word", "́ ̀", "", None, "5", "́e"])], "doc_id long, text string, lang string"
    )
    found = language.identify(docs.select("doc_id", "text"), language.profiles(docs)).collect()
    assert [r.lang_pred for r in sorted(found)] == ["en", "und", "und", "und", "und", "en"]


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    docs = spark.createDataFrame([(n, "text", f"l{n}") for n in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        language.profiles(docs)
