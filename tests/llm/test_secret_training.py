"""Every labelled finding trains the network or sets its threshold, however the rows lie."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptally.llm import secrets


@pytest.fixture(scope="module")
def docs(make_docs):
    r = np.random.default_rng(6)
    word = lambda n: "".join(r.choice(list("abcdefghijklmnoprstuvwy"), n))
    key = lambda: "".join(r.choice(list("0123456789abcdef"), 40))
    rows = []
    for i in range(240):
        words = [word(int(r.integers(3, 14))) for _ in range(90)]
        rows.append((i, " ".join(words) + (f' token = "{key()}" .' if i % 3 == 0 else ""), "a"))
    return make_docs([*rows, rows[0], (900, None, "a"), (901, "", "a")])


def by_hand(docs):
    """Windows of the runs in distinct texts that are no secrets, and distinct windows of secrets."""
    others, shown = [], set()
    for text in {r.text for r in docs.collect() if r.text}:
        for a, b, hit in secrets.candidates(text, *secrets.base_spans(text)):
            windows = secrets.windows(text, a, b)
            shown |= set(windows) if hit else set()
            others += [] if hit else windows
    return len(others), len(shown)


@pytest.mark.parametrize("size", [8 << 20, 20_000])
def test_every_finding_counts_once(docs, monkeypatch, size):
    monkeypatch.setattr(secrets, "SHARD_BYTES", size)
    found, texts = secrets.findings(docs)
    others, shown = by_hand(docs)
    assert others > 8000
    assert found.count() == shown
    held = F.pmod("hash", F.lit(4)) == 0
    net, taught, _ = secrets._fitted_network(found.where(~held), texts.where(~held))
    (_, number), (_, seen), (_, alone) = secrets._held_logits(found.where(held), texts.where(held).distinct(), net)
    assert taught + number.sum() == others
    assert seen.sum() == alone.sum() == found.where(held).count()


def test_the_network_does_not_depend_on_how_rows_lie(docs, monkeypatch):
    monkeypatch.setattr(secrets, "SHARD_BYTES", 20_000)
    (one, low), (other, high) = (secrets.learn(x) for x in (docs.coalesce(1), docs.orderBy(F.desc("doc_id")).repartition(7)))
    assert low == high
    assert (one.packed() == other.packed()).all()


def test_shards_teach_together(docs, monkeypatch):
    """What several shards learn finds keys without a keyword, and few words."""
    monkeypatch.setattr(secrets, "SHARD_BYTES", 20_000)
    r = np.random.default_rng(1)
    key = lambda: "".join(r.choice(list("0123456789abcdef"), 30))
    texts = [x.text for x in docs.limit(200).collect() if x.text]
    planted = [f"{t[:300]} {key()} {t[300:]}" for t in texts]
    _, found = secrets.spans_in(planted, secrets.learn(docs))
    hits = [any(t[s.start : s.end] == t[301:331] for s in spans) for t, spans in zip(planted, found, strict=True)]
    assert np.mean(hits) >= 0.9
    assert sum(map(len, found)) - sum(hits) <= 0.2 * len(texts)


def test_a_table_without_secrets_adds_nothing(make_docs):
    assert secrets.learn(make_docs([(1, "some plainest words here", "a"), (2, None, "a")])) is None
    assert secrets.learn(make_docs([])) is None
