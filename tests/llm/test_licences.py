"""Licence scans against plain Python over word lists."""

import re

import pyarrow as pa
import pytest

from shoptally.llm import licences
from shoptally.llm.words import SEPARATORS, slices

MIT = licences.LICENCES[0][1]
BSD2, BSD3 = (next(t for label, t, _ in licences.LICENCES if label == f"bsd-{n}-clause") for n in (2, 3))


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(SEPARATORS, lowered) if w]


def base_by_hand(text):
    words = plain_words(text)
    return [
        (i, label)
        for phrase, label in licences.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]


def score_by_hand(words, licence, found):
    """The best share of weight that a licence has at a place that one of its proposing words gives."""
    best, counts = 0.0, set()
    index = licences.index()
    starts = {i - int(licence.places[k]) for k in licence.proposing for i in found.get(licence.numbers[k], ())}
    for s in sorted(starts):
        met = sum(
            w
            for q, number, w in zip(licence.places.tolist(), licence.numbers, licence.weights.tolist(), strict=True)
            if any(abs(i - s - q) <= licences.DRIFT for i in found.get(number, ()))
        )
        best = max(best, met / licence.weight)
        low, high = max(0, s - licences.DRIFT), min(s + licence.length + licences.DRIFT, len(words))
        part = words[low:high]
        phrases = [[index.words[n] for n in p] for p in licence.phrases]
        if met / licence.weight >= licences.MIN_SCORE - 1e-9 and all(
            any(part[i : i + len(p)] == p for i in range(len(part))) for p in phrases
        ):
            counts.add(licence.label)
    return best, counts


def test_report(spark, documents, texts):
    rows = licences.report(documents).collect()
    assert len(rows) == len(texts)
    number = {w: i for i, w in enumerate(licences.index().words)}
    for r in rows:
        words, base = plain_words(texts[r.doc_id]), base_by_hand(texts[r.doc_id])
        places = [i for i, _ in base]
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if base else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        found = {}
        for i, w in enumerate(words):
            if w in number:
                found.setdefault(number[w], []).append(i)
        scores = [score_by_hand(words, x, found) for x in licences.index().licences]
        assert set(r.labels.split(",")) - {""} == {label for _, label in base}.union(*(c for _, c in scores))
        assert r.score == pytest.approx(1.0 if base else max(s for s, _ in scores), abs=1e-8)
    assert {"all-rights-reserved", "cc-by-nc"} <= {label for r in rows for label in r.labels.split(",")}


@pytest.mark.parametrize("label, text", [(label, text) for label, text, _ in licences.LICENCES])
def test_every_licence_is_found_in_other_text(label, text):
    filler = " ".join(f"word{i}" for i in range(60))
    lines = "\n * ".join(re.findall(r".{1,50}(?:\s|$)", text))
    altered = text.replace("software", "library", 1) if len(text.split()) > 30 else text
    for body in (text, lines, text.upper(), altered):
        _, scores, places = licences.found_in(pa.array([f"{filler} {body} {filler}"]))
        assert label in {p["label"] for p in places[0]} and scores[0] >= licences.MIN_SCORE


def test_key_phrases_must_stand():
    without = BSD3.replace("prior written permission", "prior consent")
    labels = {p["label"] for p in licences.found_in(pa.array([without]))[2][0]}
    assert "bsd-3-clause" not in labels and "bsd-2-clause" in labels
    scattered = " x ".join(MIT.split())
    assert licences.found_in(pa.array([scattered]))[2][0] == []


def test_a_licence_inside_a_larger_one_is_not_reported():
    assert [p["label"] for p in licences.found_in(pa.array([BSD3]))[2][0]] == ["bsd-3-clause"]
    two = licences.found_in(pa.array([f"{BSD2} {BSD3} {BSD2}"]))[2][0]
    assert [p["label"] for p in two] == ["bsd-2-clause", "bsd-3-clause", "bsd-2-clause"]
    assert two[0]["end"] <= two[1]["start"] + licences.DRIFT


def test_slices_of_a_batch_keep_their_rows():
    texts = [None, "", "Released under the MIT License.", "é " * 300, f"{MIT} {BSD3}", "x"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    whole = [licences.found_in(pa.array([t], pa.string())) for t in texts]
    at = 0
    for part in slices(iter([batch]), "text", 1500):
        n_words, scores, places = licences.found_in(part.column("text"))
        for i in range(len(part)):
            one = whole[at + i]
            assert (n_words[i], scores[i], places[i]) == (one[0][0], one[1][0], one[2][0])
        at += len(part)
    assert at == len(texts)


def test_odd_rows(odd_docs, make_docs):
    rows = licences.report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in rows if r.doc_id in (1, 2, 3)} == {
        (0, 0, None, "", 0.0)
    }
    assert licences.report(odd_docs.limit(0)).count() == 0
    assert licences.scan(odd_docs).columns[: len(odd_docs.columns)] == odd_docs.columns
    many = "Under the MIT license; " * 20_000 + MIT
    (r,) = licences.report(make_docs([(None, many, None)])).collect()
    assert (r.doc_id, r.n_base, r.first_word, r.last_word) == (None, 20_000, 0, 4 * 19_999)
    assert (r.base_labels, r.labels, r.score) == ("mit", "mit", 1.0)
