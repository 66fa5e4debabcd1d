"""Repeated passages: every byte covered by a string of ``MATCH`` bytes that also starts earlier.

Each string of MATCH bytes has one anchor inside it, the GRAM-byte piece with the smallest hash (the
leftmost such), so equal strings have equal anchors at equal distances.  Neighbouring strings share an
anchor; such a run of strings is one row, dealt to a task by the anchor's hash.

1. Rows whose whole runs are equal (by prefix polynomial hashes) are settled at once: all but the
   earliest are copies.  This is done inside each input chunk first and then per anchor, so copies of a passage
   leave a chunk once.
2. Of anchors with several different runs the earliest of each go on, with their bytes.  The suffixes at
   all string starts of a run are sorted by mergesort: two suffixes are compared by their longest common
   prefix, found by binary search over prefix hashes, and by the byte after it.  Neighbours with MATCH
   bytes in common are compared byte by byte, and of each class all but the earliest are copies.

Anchors with very many runs (a common line in many surroundings) would put a large group into one task.
A counter per slot of anchor hashes, of fixed size, is summed over all chunks before; the runs of anchors in
a full slot are dealt string by string, by the hash of the MATCH bytes.  Anchors that only share the
slot are dealt so too, which changes nothing in the result.

What a task holds does not grow with its partition: Spark sorts each partition (and spills), tasks read whole keys
or documents in blocks, texts come in chunks and longer ones in overlapping pieces, and a key with more
strings than a block is sorted in parts by the strings' hashes.

Earlier means a smaller doc_id, or the same document and an earlier start.  Strings are judged on
the input, not on what is left of it, and never cross documents.

Defined cases: a null or empty text has no bytes; texts under MATCH bytes keep all.  Null ids come
first.  Different texts under one id are ordered by a hash of the text; rows equal in id and text are one
document, and are all returned.  An empty table gives an empty table.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.llm.counters import SCHEMA, SLOTS, Counter, slot, summed
from shoptally.llm.storage import saved
from shoptally.llm.words import mix, powers, prefix_hashes, slices, span_hashes, text_bytes

MATCH = 100
GRAM = 32
WINDOW = MATCH - GRAM + 1
#: How many rows of one slot of anchors a task may get before it counts as full.
FULL = 1000
#: Bytes of text that are cut into runs at once.
CHUNK = 1 << 20
#: What a task works on at once, unless one key or document has more: rows, and bytes of runs.
BLOCK_ROWS = 200_000
BLOCK_BYTES = 1 << 20
#: How many rows of runs are dealt to a task, if the session has fewer shuffle partitions than that takes.
TASK_ROWS = 750_000
#: How many strings are sorted at once.
STRINGS = 1 << 19

_PLACE = "doc long, tie long"


# --- rows of a chunk ------------------------------------------------------------------------------


def runs(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of MATCH-byte strings with one anchor: row, start, n strings, anchor's distance, hashes."""
    total = len(data)
    names = ("row", "start", "n", "off", "key", "ctx")
    if total < MATCH:
        return {k: np.zeros(0, np.uint64 if k in ("key", "ctx") else np.int64) for k in names}
    prefix = prefix_hashes(data)
    gram = mix((prefix[GRAM:] - prefix[:-GRAM]) * powers(total + 1)[1][: total - GRAM + 1])
    least, at = (gram >> np.uint64(32)).astype(np.uint32), np.arange(len(gram), dtype=np.int32)
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        later = least[step:] < least[:-step]
        least = np.where(later, least[step:], least[:-step])
        at = np.where(later, at[step:], at[:-step])
        width += step
    starts = np.arange(len(at))
    inside = starts + MATCH <= np.repeat(offsets[1:], np.diff(offsets))[: len(at)]
    starts, at = starts[inside], at[inside].astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(starts)))
    start, anchor = starts[first], at[first]
    off = anchor - start
    row = np.searchsorted(offsets, start, side="right") - 1
    ctx = span_hashes(prefix, start, start + n - 1 + MATCH) ^ mix(off.astype(np.uint64))
    return {"row": row, "start": start, "n": n, "off": off, "key": gram[anchor], "ctx": ctx}


def _copies(key: np.ndarray, ctx: np.ndarray, *place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, ctx, place); which rows in it are the first of their class; which are copies.

    A row at the very place of its class's first is that row again, and no copy.
    """
    order = np.lexsort((*reversed(place), ctx, key))
    new = np.ones(len(order), bool)
    k, c = key[order], ctx[order]
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    differs = np.zeros(len(order), bool)
    for p in place:
        p = p[order]
        differs |= p != p[head]
    return order, new, differs


def _merged(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans joined where they touch or overlap, ordered by document and start."""
    if not len(doc):
        return doc, tie, start, end
    order = np.lexsort((start, tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    base = np.cumsum(other) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + base)
    new = other.copy()
    new[1:] |= start[1:] + base[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], tie[at], start[at], np.maximum.reduceat(end, at)


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Rows of about ``limit`` bytes of text, and where in its text a piece begins.

    A longer text comes in pieces; each string of MATCH bytes is whole in one of them and starts in no other.
    """
    for batch in slices(batches, "text", limit):
        data, _ = text_bytes(batch.column("text"))
        if len(batch) > 1 or len(data) <= limit:
            yield batch, 0
            continue
        at = batch.schema.get_field_index("text")
        for begin in range(0, len(data) - MATCH + 1, limit):
            piece = pa.array([data[begin : begin + limit + MATCH - 1].tobytes()])
            yield batch.set_column(at, "text", piece), begin


def _chunk_rows(
    batch: pa.RecordBatch, full: np.ndarray | None, begin: int = 0
) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, ...]]:
    """First rows of each class in a chunk, and the spans of the others."""
    data, offsets = text_bytes(batch.column("text"))
    found = runs(data, offsets)
    if full is not None and len(found["key"]):
        split = full[slot(found["key"])]
        if split.any():
            n = found["n"][split]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(found["start"][split], n) + step
            name = span_hashes(prefix_hashes(data), start, start + MATCH)
            one = {
                "row": np.repeat(found["row"][split], n),
                "start": start,
                "n": np.ones(len(start), np.int64),
                "off": np.zeros(len(start), np.int64),
                "key": mix(name ^ np.uint64(0x5851F42D4C957F2D)),
                "ctx": name,
            }
            found = {k: np.concatenate([v[~split], one[k]]) for k, v in found.items()}
    row = found.pop("row")
    doc = batch.column("doc").to_numpy(zero_copy_only=False)[row]
    tie = batch.column("tie").to_numpy(zero_copy_only=False)[row]
    found |= {"doc": doc, "tie": tie, "start": found["start"] - offsets[row] + begin}
    order, new, copy = _copies(found["key"], found["ctx"], doc, tie, found["start"])
    spans = order[copy]
    end = found["start"] + found["n"] - 1 + MATCH
    merged = _merged(doc[spans], tie[spans], found["start"][spans], end[spans])
    firsts = np.sort(order[new])  # in document order, which packs better
    return {k: v[firsts] for k, v in found.items()}, merged


# --- suffix sort ----------------------------------------------------------------------------------


class Suffixes:
    """Suffixes of a buffer, compared on their first MATCH bytes by hashes."""

    def __init__(self, data: np.ndarray) -> None:
        self.data, self.prefix = data, prefix_hashes(data)
        self.down = powers(len(data) + 1)[1]

    def _hash(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.down[at]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix, MATCH at most: a binary search for each pair."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), MATCH)
        for _ in range(MATCH.bit_length()):
            middle = (low + high + 1) // 2
            equal = self._hash(x, middle) == self._hash(y, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def after(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x comes after suffix y."""
        n = self.common(x, y)
        at = np.minimum(n, MATCH - 1)
        return (n < MATCH) & (self.data[x + at] > self.data[y + at])

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Stable order of suffixes inside each group; ``group`` ascends.

        Mergesort from below: each suffix looks for its place in the run beside its own by
        binary search, all suffixes of a level at once.
        """
        n = len(at)
        order = np.arange(n)
        first = np.searchsorted(group, group, side="left")
        last = np.searchsorted(group, group, side="right")
        width, longest = 1, int((last - first).max(initial=0))
        while width < longest:
            place = np.arange(n) - first
            own = place // width
            beside = first + (own ^ 1) * width
            low, high = np.minimum(beside, last), np.minimum(beside + width, last)
            begin, left = low.copy(), own % 2 == 0
            active = np.flatnonzero(low < high)
            while len(active):
                middle = (low[active] + high[active]) // 2
                mine, theirs = at[order[active]], at[order[middle]]
                # A suffix of the left run stands before equal ones of the right run.
                past = np.where(left[active], self.after(mine, theirs), ~self.after(theirs, mine))
                low[active] = np.where(past, middle + 1, low[active])
                high[active] = np.where(past, high[active], middle)
                active = active[low[active] < high[active]]
            target = first + (own // 2) * 2 * width + place % width + (low - begin)
            moved = np.empty(n, np.int64)
            moved[target] = order
            order, width = moved, 2 * width
        return order

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether MATCH bytes are the same, byte by byte."""
        out = np.zeros(len(x), bool)
        line = np.arange(MATCH)
        for i in range(0, len(x), 20_000):
            out[i : i + 20_000] = (self.data[x[i : i + 20_000, None] + line] == self.data[y[i : i + 20_000, None] + line]).all(axis=1)
        return out


def _strings(
    suffixes: Suffixes, base: np.ndarray, columns: dict[str, np.ndarray], part: int, parts: int
) -> tuple[np.ndarray, ...]:
    """Row, place in the run, distance to the anchor and name of the strings whose name falls to ``part``."""
    n = columns["n"]
    ends, found, a = np.cumsum(n), [], 0
    while a < len(n) or not found:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STRINGS, side="right")))
        row = np.repeat(np.arange(a, min(b, len(n))), n[a:b])
        step = np.arange(len(row)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
        # Equal strings have the anchor at the same distance.
        distance = columns["off"][row] - step
        name = suffixes._hash(base[row] + step, np.full(len(row), MATCH))
        name ^= mix(columns["key"][row] + distance.astype(np.uint64))
        if parts > 1:
            mine = mix(name) % np.uint64(parts) == part
            row, step, distance, name = (x[mine] for x in (row, step, distance, name))
        found.append((row, step, distance, name))
        a = b
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def copied(contexts: np.ndarray, lengths: np.ndarray, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Spans of the strings that start earlier in another row of their anchor.

    ``contexts`` are the bytes of all runs, one after the other; ``columns`` are key, doc, tie, start, n, off.
    """
    suffixes, base = Suffixes(contexts), np.cumsum(lengths) - lengths
    parts = max(1, -(-int(columns["n"].sum()) // STRINGS))
    found = [_copied_part(suffixes, base, columns, part, parts) for part in range(parts)]
    return _merged(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _copied_part(
    suffixes: Suffixes, base: np.ndarray, columns: dict[str, np.ndarray], part: int, parts: int
) -> tuple[np.ndarray, ...]:
    row, step, distance, name = _strings(suffixes, base, columns, part, parts)
    # A string whose hash occurs once has no copy.
    _, inverse, count = np.unique(name, return_inverse=True, return_counts=True)
    row, step, distance = (x[count[inverse] > 1] for x in (row, step, distance))
    order = np.lexsort((columns["start"][row], columns["tie"][row], columns["doc"][row], distance, columns["key"][row]))
    row, step, distance = row[order], step[order], distance[order]
    key = columns["key"][row]
    new = np.ones(len(row), bool)
    new[1:] = (key[1:] != key[:-1]) | (distance[1:] != distance[:-1])
    group, at = np.cumsum(new), base[row] + step
    order = suffixes.sort(at, group)
    row, step, at, group = row[order], step[order], at[order], group[order]
    near = (group[1:] == group[:-1]) & (suffixes.common(at[1:], at[:-1]) == MATCH)
    both = np.flatnonzero(near)
    near[both] = suffixes.equal(at[both + 1], at[both])
    head = np.ones(len(row), bool)
    head[1:] = ~near
    # The sort is stable and began in document order, so the first of a class is the earliest.
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    doc, tie, start = columns["doc"][row], columns["tie"][row], columns["start"][row] + step
    copy = (doc != doc[first]) | (tie != tie[first]) | (start != start[first])
    return _merged(doc[copy], tie[copy], start[copy], start[copy] + MATCH)


# --- Spark ----------------------------------------------------------------------------------------


def _blocks(
    batches: Iterator[pa.RecordBatch], by: list[str], limit: int, weight: Callable[[pa.RecordBatch], int] = len
) -> Iterator[pa.Table]:
    """Tables of about ``limit`` in weight, with whole groups of ``by``; rows come with those of a group together."""
    kept: list[pa.RecordBatch] = []
    held, last = 0, None
    for batch in batches:
        for at in range(0, len(batch), 2048):
            rows = batch.slice(at, 2048)
            groups = np.stack([_numpy(rows, c) for c in by])
            new = np.ones(len(rows), bool)
            new[1:] = (groups[:, 1:] != groups[:, :-1]).any(axis=0)
            new[0] = last is not None and bool((groups[:, 0] != last).any())
            begins, last = np.flatnonzero(new), groups[:, -1]
            if held + weight(rows) > limit and len(begins):
                yield pa.Table.from_batches([*kept, rows.slice(0, begins[-1])]).combine_chunks()
                kept, held, rows = [], 0, rows.slice(begins[-1])
            kept.append(rows)
            held += weight(rows)
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _numpy(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _dealt(rows: DataFrame, tasks: int, *by: str) -> DataFrame:
    """Rows dealt out and ordered by columns; to ``tasks`` tasks where the session has fewer."""
    few = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) < tasks
    return (rows.repartition(tasks, *by) if few else rows.repartition(*by)).sortWithinPartitions(*by)


def _slot_rows(placed: DataFrame) -> np.ndarray:
    """How many rows each slot holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch, _ in _chunks(batches, CHUNK):
            counter.add(_chunk_rows(batch, None)[0]["key"])
        yield from counter.parts()

    return summed(placed.mapInArrow(count, SCHEMA))


def _full_slots(placed: DataFrame, total: np.ndarray | None = None) -> np.ndarray:
    """Which slots hold too many rows."""
    total = _slot_rows(placed) if total is None else total
    return total > max(FULL, 8 * int(total.sum()) // SLOTS)


def _settle_runs(placed: DataFrame, full: np.ndarray, tasks: int = 0) -> DataFrame:
    """(doc, tie, key, start, pack): spans of copies (key 0, pack is the end), and runs to be sorted.

    pack holds the number of strings and the anchor's distance of a run.
    """
    sent = placed.sparkSession.sparkContext.broadcast(full)

    def batch_of(key: np.ndarray, ctx: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray, pack: np.ndarray):
        arrays = [np.ascontiguousarray(x).view(np.int64) for x in (key, ctx, doc, tie, start, pack)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["key", "ctx", "doc", "tie", "start", "pack"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin in _chunks(batches, CHUNK):
            rows, (doc, tie, start, end) = _chunk_rows(batch, sent.value, begin)
            yield batch_of(rows["key"], rows["ctx"], rows["doc"], rows["tie"], rows["start"], rows["n"] << 8 | rows["off"])
            # Spans are final; a negative pack marks them, and they are dealt out by document.
            yield batch_of(mix(doc.astype(np.uint64)), np.zeros(len(doc), np.int64), doc, tie, start, -end)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, ["key"], BLOCK_ROWS):
            c = {name: _numpy(table, name) for name in table.column_names}
            final = c["pack"] < 0
            out = [(np.zeros(final.sum(), np.int64), c["doc"][final], c["tie"][final], c["start"][final], -c["pack"][final])]
            c = {k: v[~final] for k, v in c.items()}
            order, new, copy = _copies(c["key"], c["ctx"], c["doc"], c["tie"], c["start"])
            s = order[copy]
            spans = _merged(c["doc"][s], c["tie"][s], c["start"][s], c["start"][s] + (c["pack"][s] >> 8) - 1 + MATCH)
            out.append((np.zeros(len(spans[0]), np.int64), *spans))
            # Of anchors with several different runs, the first row of each.
            firsts = order[new]
            key = c["key"][firsts]
            again = np.zeros(len(key), bool)
            again[1:] = key[1:] == key[:-1]
            again[:-1] |= again[1:]
            left = firsts[again]
            out.append((c["key"][left], c["doc"][left], c["tie"][left], c["start"][left], c["pack"][left]))
            for key, doc, tie, start, pack in out:
                arrays = [pa.array(x) for x in (key, doc, tie, start, pack)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "doc", "tie", "start", "pack"])

    rows = placed.mapInArrow(cut, f"key long, ctx long, {_PLACE}, start long, pack long")
    return _dealt(rows, tasks, "key").mapInArrow(settle, f"key long, {_PLACE}, start long, pack long")


def _by_document(rows: DataFrame, tasks: int = 0) -> DataFrame:
    """One row per (doc, tie): merged spans (starts, ends) and runs to be sorted (keys, at, packs)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, ["doc", "tie"], BLOCK_ROWS):
            c = {name: _numpy(table, name) for name in table.column_names}
            span = c["key"] == 0
            doc, tie, start, end = _merged(*(c[k][span] for k in ("doc", "tie", "start", "pack")))
            left = np.flatnonzero(~span)
            left = left[np.lexsort((c["tie"][left], c["doc"][left]))]
            every = np.unique(np.stack([np.append(doc, c["doc"][left]), np.append(tie, c["tie"][left])], axis=1), axis=0)

            def lists(d: np.ndarray, t: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
                # Both sides are ordered by (doc, tie), so ranks give where each list begins.
                pairs = np.concatenate([every, np.stack([d, t], axis=1)])
                _, rank = np.unique(pairs, axis=0, return_inverse=True)
                counts = np.bincount(rank.ravel()[len(every) :], minlength=len(every))
                ends = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                return [pa.ListArray.from_arrays(ends, pa.array(v)) for v in values]

            columns = [pa.array(np.ascontiguousarray(every[:, 0])), pa.array(np.ascontiguousarray(every[:, 1]))]
            columns += lists(doc, tie, start, end)
            columns += lists(c["doc"][left], c["tie"][left], *(c[k][left] for k in ("key", "start", "pack")))
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "tie", "starts", "ends", "keys", "at", "packs"])

    lists = ", ".join(f"{x} array<long>" for x in ("starts", "ends", "keys", "at", "packs"))
    return _dealt(rows, tasks, "doc", "tie").mapInArrow(gather, f"{_PLACE}, {lists}")


def _sorted_copies(placed: DataFrame, settled: DataFrame) -> DataFrame:
    """(key, doc, tie, start, pack) spans (key 0) that the suffix sort finds among the runs left."""

    def with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK):
            data, offsets = text_bytes(batch.column("text"))
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(batch.column("keys")).to_numpy(zero_copy_only=False))
            start, pack, key = (_numpy_values(batch.column(k)) for k in ("at", "packs", "keys"))
            length = (pack >> 8) - 1 + MATCH
            begin, until, a = offsets[row] + start, np.cumsum(length), 0
            while a < len(row):
                # Runs overlap, so that their bytes may be many times the text's.
                b = max(a + 1, int(np.searchsorted(until, (until[a - 1] if a else 0) + BLOCK_BYTES, side="right")))
                mine, ends = length[a:b], np.cumsum(length[a:b])
                place = np.repeat(begin[a:b] - (ends - mine), mine) + np.arange(ends[-1])
                bounds = pa.array(np.append(0, ends).astype(np.int32))
                bodies = pa.Array.from_buffers(
                    pa.binary(), b - a, [None, bounds.buffers()[1], pa.py_buffer(data[place].tobytes())]
                )
                columns = [pa.array(key[a:b]), *(batch.column(c).take(pa.array(row[a:b])) for c in ("doc", "tie"))]
                columns += [pa.array(start[a:b]), pa.array(pack[a:b]), bodies]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc", "tie", "start", "pack", "body"])
                a = b

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, ["key"], BLOCK_BYTES, lambda rows: int(((_numpy(rows, "pack") >> 8) + MATCH).sum())):
            c = {name: _numpy(table, name) for name in ("key", "doc", "tie", "start", "pack")}
            c |= {"n": c["pack"] >> 8, "off": c["pack"] & 255, "key": c["key"].view(np.uint64)}
            bodies = table.column("body").combine_chunks()
            bodies = bodies.chunk(0) if isinstance(bodies, pa.ChunkedArray) else bodies
            data, _ = text_bytes(bodies)
            doc, tie, start, end = copied(data, c["n"] - 1 + MATCH, c)
            arrays = [pa.array(x) for x in (np.zeros(len(doc), np.int64), doc, tie, start, end)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "doc", "tie", "start", "pack"])

    left = settled.where("size(keys) > 0").select("doc", "tie", "keys", "at", "packs")
    # All columns of the documents are kept, so that this join and the last one share one exchange.
    bodies = placed.join(left, ["doc", "tie"]).mapInArrow(
        with_bytes, f"key long, {_PLACE}, start long, pack long, body binary"
    )
    return _dealt(bodies, 0, "key").mapInArrow(sort, f"key long, {_PLACE}, start long, pack long")


def _numpy_values(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _placed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """doc, tie, text, doc_id: the order of documents, the text without null; whether ids are repeated."""
    text = F.coalesce(F.col("text"), F.lit(""))
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeats = not repeated.isEmpty()
    tie = F.xxhash64(text) if repeats else F.lit(0).cast("long")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    return docs.select(doc.alias("doc"), tie.alias("tie"), text.alias("text"), "doc_id"), repeats


def report(docs: DataFrame) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256."""
    placed, repeats = _placed(docs.select("doc_id", "text"))
    texts = placed.select("doc", "tie", "text")
    total = _slot_rows(texts)
    tasks = int(total.sum()) // TASK_ROWS
    settled = saved(_by_document(_settle_runs(texts, _full_slots(texts, total), tasks), tasks), release=True)
    once = placed.dropDuplicates(["doc", "tie"]) if repeats else placed
    more = _by_document(_sorted_copies(once, settled)).select(
        "doc", "tie", F.col("starts").alias("more_starts"), F.col("ends").alias("more_ends")
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            lists = [batch.column(c).to_pylist() for c in ("starts", "ends", "more_starts", "more_ends")]
            removed, count, digest = [], [], []
            for i in range(len(batch)):
                body = data[offsets[i] : offsets[i + 1]]
                start = np.array((lists[0][i] or []) + (lists[2][i] or []), np.int64)
                end = np.array((lists[1][i] or []) + (lists[3][i] or []), np.int64)
                zero = np.zeros(len(start), np.int64)
                _, _, start, end = _merged(zero, zero, start, end)
                keep = [body[a:b].tobytes() for a, b in zip(np.append(0, end), np.append(start, len(body)), strict=True)]
                removed.append(int((end - start).sum()))
                count.append(len(start))
                digest.append(hashlib.sha256(b"".join(keep)).hexdigest())
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64())]
            columns += [pa.array(count, pa.int64()), pa.array(digest)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = placed.join(settled.select("doc", "tie", "starts", "ends"), ["doc", "tie"], "left")
    joined = joined.join(more, ["doc", "tie"], "left")
    return joined.select("doc_id", "text", "starts", "ends", "more_starts", "more_ends").mapInArrow(
        cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
