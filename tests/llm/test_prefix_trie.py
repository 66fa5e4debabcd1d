"""The trie of conversation prefixes against plain Python."""

import hashlib
import random
import zlib

import pytest

from shoptally.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n1 string, at string"


def trie_by_hand(sequences):
    """Rows of all nodes of {conv_id: [(role, text), ...]}."""
    members, ends = {}, {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in below)
    return {
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])),
            leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, m in members.items()
    }


def spelt(role, text):
    return hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()


def sequences_by_hand(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, spelt(role, text), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt_by_hand(rows):
    own = sequences_by_hand(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 5, "n", "x") for r in rows], SCHEMA).repartition(3)

    return make


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_report(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in conversations.collect()]
    assert found(prefix_trie.report(conversations)) == trie_by_hand(rebuilt_by_hand(rows))


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(frame, seed):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-150, 450), 60):
        turns = [(c, i, r.choice("ua"), r.choice(["x", "yy", ""])) for i in range(r.choice([1, 2, 3, 8, 9]))]
        rows += turns
    assert found(prefix_trie.report(frame(rows))) == trie_by_hand(rebuilt_by_hand(rows))
    plain = prefix_trie.trie(*prefix_trie.sequences(frame(rows)))
    assert found(plain) == trie_by_hand(sequences_by_hand(rows))


def test_long_and_equal_conversations(frame):
    long = [(7, i, "u", f"t{i % 3}") for i in range(700)]
    near = [(c, i, "u", f"t{i % 3}" if i < 64 + c else "other") for c in (11, 12) for i in range(140)]
    equal = [(c, i, "u", "same") for c in range(1000, 1200) for i in range(2)]
    rows = long + near + equal
    plain = prefix_trie.trie(*prefix_trie.sequences(frame(rows)))
    assert found(plain) == trie_by_hand(sequences_by_hand(rows))


def test_ids_of_many_chunks(spark):
    rows = spark.range(-5000, 5000).selectExpr("id AS conv_id", "0L AS turn", "'u' AS role", "'t' AS text")
    nodes = {r.depth: r for r in prefix_trie.trie(*prefix_trie.sequences(rows)).collect()}
    ids = ",".join(map(str, range(-5000, 5000)))
    assert nodes[1].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert (nodes[1].conv_id, nodes[1].n_convs, nodes[0].n_children) == (-5000, 10_000, 1)


def test_odd_rows(frame):
    rows = [
        (1, None, None, None), (1, 0, "u", None), (1, 0, "u", None), (1, 1, None, "é" * 3),
        (2, 5, "u", ""), (2, 5, "a", ""), (2, None, "u", "x"), (None, 1, "u", "lost"), (None, None, None, None),
        (100, 0, "u", "y" * 50_000), (101, 0, "u", "y" * 50_000), (102, 3, "", "u"), (103, 3, "u", ""),
    ]
    assert found(prefix_trie.report(frame(rows))) == trie_by_hand(rebuilt_by_hand(rows))
    plain = prefix_trie.trie(*prefix_trie.sequences(frame(rows)))
    assert found(plain) == trie_by_hand(sequences_by_hand(rows))


def test_conversations_without_turns(frame):
    """103 keeps none of its own turns and its family's first conversation is absent."""
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(c, 0, "u", "x")]
    wanted = {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}
    assert found(prefix_trie.report(frame(rows))) == wanted == trie_by_hand(rebuilt_by_hand(rows))


def test_empty_table(frame):
    df = prefix_trie.report(frame([(1, 1, "u", "x")]).limit(0))
    assert df.count() == 0 and df.columns[0] == "conv_id" and df.columns[-1] == "ends_sha256"
