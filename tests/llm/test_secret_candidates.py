"""Which runs of characters the network judges, and what it sees of them."""

import random
import string

import numpy as np
import pytest

from shoptally.llm import secrets


def test_runs_without_a_digit_are_candidates():
    text = "an app password abcdefghqrstuvwx here"
    assert [text[a:b] for a, b, _ in secrets.candidates(text, *secrets.base_spans(text))] == [
        "password", "abcdefghqrstuvwx",
    ]


@pytest.mark.parametrize("length", [8, 47, 48, 49, 72, 73, 500])
def test_windows_cover_a_candidate(length):
    body = "".join(random.Random(length).choices(string.ascii_letters, k=length))
    text = f"x {body} y"
    shown = [w[secrets.BEFORE : secrets.BEFORE + secrets.BODY_LENGTH].rstrip("\0") for w in secrets.windows(text, 2, 2 + length)]
    assert all(body[at : at + 24] in "\n".join(shown) for at in range(max(1, length - 23)))
    assert all(len(w) == secrets.LENGTH for w in secrets.windows(text, 2, 2 + length))


def test_logits_are_the_networks_output():
    r = np.random.default_rng(0)
    net, codes = secrets.CharNet(), r.integers(0, 98, (300, secrets.LENGTH))
    net.bias += r.normal(0, 0.3, net.bias.shape)
    assert net.logits(codes) == pytest.approx(net._forward(codes)[-1])


class CapitalQ:
    """Scores a window 1 if a Q is in its body."""

    def scores(self, codes):
        body = codes[:, secrets.BEFORE : secrets.BEFORE + secrets.BODY_LENGTH]
        return (body == ord("Q") - 31).any(axis=1).astype(float)


def test_a_key_of_letters_and_one_inside_a_long_path_are_judged():
    long = "development/" * 6 + "abQcdefg" + "/understanding" * 6
    texts = ["set it to abcdefghQrstuvwx now", f"see {long} now", "plain development"]
    found = [(i, a, b) for i, t in enumerate(texts) for a, b, _ in secrets.candidates(t, *secrets.base_spans(t))]
    assert secrets.model_spans(texts, found, (CapitalQ(), 0.5)) == [(0, 10, 26), (1, 4, 4 + len(long))]
