"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shoptally.llm import resampling
from shoptally.llm.words import SEPARATORS, slices, split_words


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(SEPARATORS, lowered) if w]


def grams(text, order):
    words = plain_words(text)
    return [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10_000


def by_hand(docs, target, order=1):
    """(id, features, weight, score, rank) of rows (id, text)."""
    s = Counter(bucket(g) for _, t in docs for g in grams(t, order))
    t = Counter(bucket(g) for x in target for g in grams(x, order))
    ns, nt = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    out = []
    for i, text in docs:
        found = grams(text, order)
        gains = [math.floor(1000 * math.log((t[b] + 1) * ns / ((s[b] + 1) * nt))) for b in map(bucket, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, len(plain_words(text)) >= 20])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: 10 * len(able) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in out]


def test_report(spark, documents, texts):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    target = [r.text for r in benchmark.collect()]
    found = {tuple(r) for r in resampling.report(documents, benchmark).collect()}
    wanted = by_hand(list(texts.items()), target)
    assert found == set(wanted) and sum(r[4] is not None for r in wanted) > 5


@pytest.mark.parametrize("order", [1, 2, 3])
def test_longer_runs(spark, documents, texts, order):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    target = [r.text for r in benchmark.collect()]
    rows = resampling.weighed(documents, benchmark, order).collect()
    wanted = {r[0]: r[1:4] for r in by_hand(list(texts.items()), target, order)}
    assert {r.doc_id: (r._r_features, r._r_weight, r._r_score) for r in rows} == wanted


def test_slices_of_a_batch_keep_their_rows():
    texts = [("é" * (i % 7) + f" Word{i} x, ") * (i % 5) or None for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    at = 0
    for part in slices(iter([batch]), "text", 500):
        words, rows = split_words(part.column("text"))
        found = [[] for _ in range(len(part))]
        for word, row in zip(words.to_pylist(), rows.tolist(), strict=True):
            if word:
                found[row].append(word)
        assert found == [plain_words(t) for t in texts[at : at + len(part)]]
        at += len(part)
    assert at == 400


def test_odd_rows(odd_docs):
    target = odd_docs.where("doc_id = 5")
    rows = resampling.report(odd_docs, target).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    wanted = by_hand(docs, [r.text for r in target.collect()])
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r) for r in rows), key=key) == sorted(wanted, key=key)
    assert {(r.n_features, r.weight, r.rank) for r in rows if r.doc_id in (1, 2, 3)} == {(0, 0, None)}


def test_empty_tables(odd_docs):
    assert resampling.report(odd_docs.limit(0), odd_docs).count() == 0
    assert resampling.report(odd_docs, odd_docs.limit(0)).count() == odd_docs.count()


def test_the_sample_keeps_whole_rows_and_follows_the_target(make_docs):
    good, bad = "alpha beta gamma delta ", "one two three four "
    docs = make_docs([(i, (good if i % 5 == 0 else bad) * 6, None) for i in range(400)])
    target = make_docs([(1, good * 60, "t")])
    drawn = resampling.resample(docs, target)
    rows = drawn.collect()
    assert drawn.columns == docs.columns and len(rows) == 40
    assert np.mean([r.doc_id % 5 == 0 for r in rows]) > 0.8
    copies = make_docs([(7, good * 6, "a")] * 30)
    assert resampling.resample(copies, target).count() == 3
