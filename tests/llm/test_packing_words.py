"""Ids of remembered words against the tokenizer, and the memory of the packing search."""

import random

import numpy as np
import public_tokenizers
import pytest

from shoptally.llm import packing


@pytest.fixture(scope="module")
def ids_of():
    return packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))


def differing(ids_of, texts):
    found = [np.frombuffer(b, "<u4").tolist() for b in ids_of(texts)]
    wanted = [e.ids for e in ids_of.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return [t for t, f, w in zip(texts, found, wanted, strict=True) if f != w]


def test_every_character_before_a_sign(ids_of):
    characters = [chr(i) for i in range(0x20, 0x30000) if not 0xD800 <= i < 0xE000]
    assert differing(ids_of, [f"x {c}.)" for c in characters]) == []


def test_random_strings(ids_of):
    r = random.Random(5)
    signs = list("abIZ09 \n\t.,;:!?#$%&*()|<>'`-_@²ⅷéÉΣß中😀\x00\x1ċİ")
    parts = [*signs, "T̈", "क़", "क़", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "BİRİNCİ,", "  "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(60_000)]
    assert differing(ids_of, texts) == []


def test_what_batches_share_is_remembered(monkeypatch):
    """Parts of one batch make way for parts of several, and ids stay those of the tokenizer."""
    monkeypatch.setattr(packing, "_PARTS", {})
    monkeypatch.setattr(packing, "CACHED_PARTS", 400)
    ids_of, encoded = packing.WordIds(public_tokenizers.path("word_bpe_49k.json")), []

    class Watched:
        def __getattr__(self, name):
            return getattr(ids_of_tokenizer, name)

        def encode_batch_fast(self, parts, **how):
            encoded.extend(parts)
            return ids_of_tokenizer.encode_batch_fast(parts, **how)

    ids_of_tokenizer, ids_of.tokenizer = ids_of.tokenizer, Watched()
    r = random.Random(8)
    shared = ["".join(r.choices("abcdef", k=7)) + "zz" for _ in range(100)]
    for k in range(20):
        own = [f"{''.join(r.choices('ghijkl', k=8))}" for _ in range(150)]
        texts = [" ".join([*shared, *own[:75]]) + ".", " ".join(own[75:]), ""]
        found = [np.frombuffer(b, "<u4").tolist() for b in ids_of(texts)]
        assert found == [e.ids for e in ids_of_tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert len(ids_of.known.number) <= 400 + 300
    assert all(encoded.count(p) == 1 for p in shared)


def test_the_search_keeps_few_tables(monkeypatch):
    sizes = np.random.default_rng(3).integers(1, 4096, 60_000)
    counts = {int(s): int(n) for s, n in zip(*np.unique(sizes, return_counts=True))}
    most = 0
    used = packing.Budget.used

    def watched(self, room, size):
        nonlocal most
        used(self, room, size)
        most = max(most, self.bytes if len(self.tables) > 1 else 0)

    monkeypatch.setattr(packing.Budget, "used", watched)
    monkeypatch.setattr(packing, "TABLE_BYTES", 4 << 20)
    few = packing.complete_bins(counts, steps=100_000)
    assert 0 < most <= 4 << 20
    monkeypatch.setattr(packing, "TABLE_BYTES", 1 << 30)
    assert few == packing.complete_bins(counts, steps=100_000)
