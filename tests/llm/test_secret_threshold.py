"""The threshold keeps the recall, also of secrets without a keyword."""

import hashlib
import random

from shoptally.llm import secrets


def test_held_back_secrets_are_found_with_and_without_surroundings():
    r = random.Random(4)
    value = lambda: "".join(r.choices("abcdefgh", k=14))
    texts = [(f"my password = {value()} ok", 1) for _ in range(200)] + [(f"a plain word {value()} ok", 0) for _ in range(600)]
    samples = [(secrets.window(t, t.rindex(" ok") - 14, t.rindex(" ok")), y) for t, y in texts]
    net, threshold = secrets.train([w for w, _ in samples], [y for _, y in samples])
    held = secrets.encode([w for w, y in samples if y and hashlib.md5(w.encode()).digest()[0] % 4 == 0])
    for shown in (held, net.alone(held)):
        assert (net.scores(shown) >= threshold).mean() >= secrets.RECALL
