"""Counts of the spans that the patterns find, by kind and not by place."""

from test_brute_force import base_by_hand

from shoptally.llm import secrets

HEX, KEY = "0123456789abcdef" * 2, "AKIA" + "B" * 14
TEXTS = [
    None,
    "token = abcdefgh12",
    f"{HEX} alone",
    f"{KEY} alone",
    f"{HEX} then {KEY} then password: abcdefgh and secret=abcdefghi",
    f"token={HEX} token={KEY} {KEY} {HEX} {HEX}",
]


def test_spans_are_counted_by_kind(make_docs):
    rows = secrets.report(make_docs([(i, t, "a") for i, t in enumerate(TEXTS)])).collect()
    for r in rows:
        kinds = [k for _, k, _ in base_by_hand(TEXTS[r.doc_id] or "")]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in range(3))
    assert len(rows) == len(TEXTS)
