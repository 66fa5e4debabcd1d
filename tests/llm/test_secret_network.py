"""What the network finds that no pattern does, and that batches are scored as single windows are."""

import random
import string

import numpy as np
import pytest

from shoptally.llm import secrets

HEX, ALNUM = "0123456789abcdef", string.ascii_letters + string.digits
SHAPES = {
    "24 hexadecimal digits": lambda r: "".join(r.choices(HEX, k=24)),
    "20 letters and digits": lambda r: "".join(r.choices(ALNUM, k=20)),
    "32 letters and digits": lambda r: "".join(r.choices(ALNUM, k=32)),
    "a prefix and 36": lambda r: "ghp_" + "".join(r.choices(ALNUM, k=36)),
    "44 of base 64": lambda r: "".join(r.choices(ALNUM + "+/", k=44)),
}


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, [r.text or "" for r in docs.collect()]


@pytest.fixture(scope="module")
def model(corpus):
    return secrets.learn(corpus[0])


def planted(texts, shape, n, seed=3):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        text, value = r.choice(texts), shape(r)
        at = r.randrange(len(text) + 1)
        out.append((f"{text[:at]} {value} {text[at:]}", at + 1, at + 1 + len(value)))
    return out


def recall(model, rows):
    _, found = secrets.spans_in([t for t, _, _ in rows], model)
    return np.mean([any((s.start, s.end) == (a, b) for s in spans) for spans, (_, a, b) in zip(found, rows, strict=True)])


@pytest.mark.parametrize("shape", SHAPES)
def test_secrets_without_a_keyword_are_found(model, corpus, shape):
    assert recall(model, planted(corpus[1], SHAPES[shape], 300)) >= 0.9


def test_a_kind_that_training_did_not_see_is_found(spark, corpus):
    kind = "capitals and digits"
    codes, labels = zip(
        *[
            (secrets.window(t, a, b), int(hit))
            for t in corpus[1]
            for a, b, hit in secrets.candidates(t, *secrets.base_spans(t))
            if b - a <= secrets.BODY_LENGTH
        ],
        strict=True,
    )
    plain = [c for c, y in zip(codes, labels, strict=True) if not y]
    kept = random.Random(1).sample(plain, 4000) + [c for c, y in zip(codes, labels, strict=True) if y]
    net, threshold = secrets.train(kept, [0] * 4000 + [1] * (len(kept) - 4000), left_out=(kind,))
    alphabet = string.ascii_uppercase + string.digits
    rows = planted(corpus[1], lambda r: "".join(r.choices(alphabet, k=32)), 300)
    assert recall((net, threshold), rows) >= 0.9


def test_few_other_runs_are_taken_for_secrets(model, corpus):
    """The corpus has no secrets that the patterns miss; of its 60,000 runs at most 80 in 1,000 documents are taken for some."""
    _, found = secrets.spans_in(corpus[1], model)
    assert sum(map(len, found)) <= 0.08 * len(corpus[1])


def test_batches_are_scored_as_single_windows(model):
    r = random.Random(8)
    parts = ["word", "token = \"abcd1234abcd\"", "Zq9x" * 3, "é\U0001f600", "\0", "a" * 8, "x/y.z=" * 30, HEX * 3, "AKIA" + "B" * 16, "\n", ""]
    texts = [" ".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(300)] + ["", "9fK2" * 5]
    net, _ = model
    for threshold in (1e-9, 0.3, 0.9):
        _, added = secrets.spans_in(texts, (net, threshold))
        found = [secrets.base_spans(t) for t in texts]
        free = [(i, a, b) for i, t in enumerate(texts) for a, b, hit in secrets.candidates(t, *found[i]) if not hit]
        wanted = set(secrets.model_spans(texts, free, (net, threshold)))
        assert {(i, s.start, s.end) for i, spans in enumerate(added) for s in spans} == wanted


def test_windows_as_arrays_are_the_windows(model):
    texts = ["ab " * 9 + "k" * 130 + " tail", "short12345", "é" * 30 + " Value98765 é"]
    runs = secrets.Runs(texts, [secrets.base_spans(t) for t in texts])
    _, begin, end = runs.windowed(runs.starts, runs.ends)
    wanted = [w for t in texts for a, b, _ in secrets.candidates(t, *secrets.base_spans(t)) for w in secrets.windows(t, a, b)]
    assert (runs.windows(begin, end) == secrets.encode(wanted)).all()


def test_gradient_is_that_of_the_loss():
    r = np.random.default_rng(4)
    net = secrets.CharNet()
    net.bias += 0.1
    codes = r.integers(0, 98, (6, secrets.LENGTH))
    labels, share = np.array([0, 1, 0, 1, 1, 0.0]), np.full(6, 0.2)

    def loss():
        z = net._forward(codes)[-1]
        return float((share * (np.log1p(np.exp(z)) - labels * z)).sum())

    for weight, grad in zip(net.weights(), net._gradient(codes, labels, share), strict=True):
        flat, at = weight.reshape(-1), int(np.abs(grad).argmax())
        old = flat[at]
        flat[at] = old + 1e-5
        up = loss()
        flat[at] = old - 1e-5
        down = loss()
        flat[at] = old
        assert (up - down) / 2e-5 == pytest.approx(grad.reshape(-1)[at], rel=1e-3, abs=1e-7)
