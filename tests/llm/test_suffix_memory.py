"""What a task of op1 holds does not grow with its partition, a text, or the number of tasks before it."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from test_brute_force import _removed, passages, removed_by_hand

from shoptally.llm import counters, suffix_dedup


class Frame:
    """Takes down the functions that would run in tasks."""

    def __init__(self):
        self.tasks, self.dealt = [], []
        self.sparkSession = SimpleNamespace(
            sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)),
            conf=SimpleNamespace(get=lambda *_: "4"),
        )

    def mapInArrow(self, task, _):  # noqa: N802
        self.tasks.append(task)
        return self

    def repartition(self, *by):
        self.dealt.append(by)
        return self

    def __getattr__(self, _):
        return lambda *_, **__: self


def tasks_of(build, *more):
    frame = Frame()
    build(frame, *more)
    return frame.tasks


def peak_mb(task, batches):
    """Most memory at once while a task runs, in MB, and rows of its results."""
    tracemalloc.start()
    try:
        n = sum(len(b) for b in task(batches))
        return tracemalloc.get_traced_memory()[1] / 1e6, n
    finally:
        tracemalloc.stop()


def in_batches(columns, n=10_000):
    for at in range(0, len(next(iter(columns.values()))), n):
        yield pa.RecordBatch.from_arrays([pa.array(v[at : at + n]) for v in columns.values()], names=list(columns))


NONE_FULL = np.zeros(counters.SLOTS, bool)


def test_settling_holds_a_block_of_a_partition():
    n = 1_500_000
    at = np.arange(n)
    columns = {"key": at // 3, "ctx": at % 2, "doc": at, "tie": 0 * at, "start": 0 * at, "pack": 0 * at + (19 << 8 | 5)}
    mb, rows = peak_mb(tasks_of(suffix_dedup._settle_runs, NONE_FULL)[1], in_batches(columns))
    # Of a key's three rows one is a copy, and two differ.
    assert rows == n and mb < 100


def test_gathering_holds_a_block_of_a_partition():
    n = 1_500_000
    at = np.arange(n)
    columns = {"key": at % 2, "doc": at // 10, "tie": 0 * at, "start": 1000 * (at % 10), "pack": 1000 * (at % 10) + 300}
    mb, rows = peak_mb(tasks_of(suffix_dedup._by_document)[0], in_batches(columns))
    assert rows == n // 10 and mb < 60


def runs_of_keys(n, per_key, length):
    """Runs of a key share their bytes but for the first, so that all strings but one have copies."""
    r = np.random.default_rng(1)
    n_strings = length - suffix_dedup.MATCH + 1
    body = r.integers(97, 123, (n // per_key, length)).astype(np.uint8).repeat(per_key, axis=0)
    body[:, 0] = np.arange(n) % per_key
    at = np.arange(n)
    return {
        "key": at // per_key,
        "doc": at,
        "tie": 0 * at,
        "start": 0 * at,
        "pack": 0 * at + (n_strings << 8 | 50),
        "body": [b.tobytes() for b in body],
    }


def test_sorting_holds_a_block_of_a_partition():
    n = 60_000
    columns = runs_of_keys(n, 3, 118)
    frame = Frame()
    suffix_dedup._sorted_copies(frame, frame)
    mb, rows = peak_mb(frame.tasks[1], in_batches(columns))
    assert rows == n - n // 3 and mb < 150


def test_runs_get_their_bytes_a_block_at_a_time():
    n = 60_000
    frame = Frame()
    suffix_dedup._sorted_copies(frame, frame)
    text = "".join(map(chr, np.random.default_rng(2).integers(97, 123, n + 200)))
    lists = {"keys": np.arange(n), "at": np.arange(n), "packs": np.full(n, 60 << 8 | 5)}
    one = pa.RecordBatch.from_arrays(
        [pa.array([0]), pa.array([0]), pa.array([text]), *(pa.array([v]) for v in lists.values())],
        names=["doc", "tie", "text", *lists],
    )
    mb, rows = peak_mb(frame.tasks[0], iter([one]))
    assert rows == n and mb < 80


def test_a_long_text_is_cut_in_pieces():
    text = bytes(np.random.default_rng(3).integers(97, 123, 6_000_000).astype(np.uint8)).decode()
    one = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([text])], names=["doc", "tie", "text"])
    cut = tasks_of(suffix_dedup._settle_runs, NONE_FULL)[0]
    strings = sum(sum(p >> 8 for p in b.column("pack").to_pylist()) for b in cut(iter([one])))
    assert strings == len(text) - suffix_dedup.MATCH + 1
    mb, _ = peak_mb(cut, iter([one]))
    assert mb < 150


def test_a_batch_of_counts_is_small():
    counter = counters.Counter()
    counter.add(np.arange(5, dtype=np.uint64))
    sizes = [len(b) for batch in counter.parts() for b in batch.column("counts").to_pylist()]
    assert sum(sizes) == 4 * counters.SLOTS and 10_000 * max(sizes) < 64 << 20


def test_few_shuffle_partitions_are_raised():
    frame = Frame()
    suffix_dedup._settle_runs(frame, NONE_FULL, 9)
    suffix_dedup._settle_runs(frame, NONE_FULL, 3)
    assert frame.dealt == [(9, "key"), ("key",)]


def test_small_blocks_change_nothing(make_docs, monkeypatch):
    for name, value in (("CHUNK", 700), ("BLOCK_ROWS", 20), ("BLOCK_BYTES", 1500), ("FULL", 30), ("TASK_ROWS", 50)):
        monkeypatch.setattr(suffix_dedup, name, value)
    texts = passages()
    docs = make_docs([(i, t, "a") for i, t in texts.items()])
    assert _removed(docs) == removed_by_hand(texts)


def test_parts_of_a_key_change_nothing(monkeypatch):
    columns = {k: np.array(v) for k, v in runs_of_keys(400, 40, 150).items() if k != "body"}
    contexts = np.frombuffer(b"".join(runs_of_keys(400, 40, 150)["body"]), np.uint8)
    columns |= {"n": columns["pack"] >> 8, "off": columns["pack"] & 255, "key": columns["key"].view(np.uint64)}
    lengths = columns["n"] - 1 + suffix_dedup.MATCH
    whole = suffix_dedup.copied(contexts, lengths, columns)
    monkeypatch.setattr(suffix_dedup, "STRINGS", 2000)
    parts = suffix_dedup.copied(contexts, lengths, columns)
    assert len(whole[0]) == 390 and all((a == b).all() for a, b in zip(whole, parts, strict=True))
