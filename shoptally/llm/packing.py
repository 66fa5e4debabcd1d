"""Best-fit packing of token sequences by bin completion.

A document becomes its token ids and an end id, cut into pieces of ``capacity`` where it is longer.
How many pieces of each length there are is all that a packing depends on, and that table has at
most ``capacity`` rows whatever the size of the corpus, so the search runs on it: take the largest
length left, list the undominated fillings of the room beside it lazily and least waste first, put the
best one into as many sequences as the counts allow, and go on; go back and try the next filling where
the waste so far shows that the best packing known cannot be beaten.  The first such packing is the
best-fit one.  The search is whole unless ``NODES`` or ``STEPS`` end it.
Spark then ranks the pieces of each length and looks each rank up in the list of fillings.

Defined cases: a null or empty text is the end id alone.  Equal rows are packed as often as they
occur.  A null id stays null.  An empty table gives an empty table.  Only doc_id and text are read.
"""

from __future__ import annotations

import itertools
import os
import sys
import unicodedata
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptally.llm.storage import saved
from shoptally.llm.words import slices

CAPACITY = 4096
END_ID = 1
CHUNKS = 1024
#: Parts of words whose ids a worker remembers, and bytes of text that it takes apart at once.
CACHED_PARTS = 400_000
TEXT_BYTES = 4 << 20
#: Signs that end a word; none of them begins a contraction or a special token's last part.
SIGNS = ".,;:!?#$%&*()"
#: Fillings that the search chooses in all, and steps that their enumeration takes in all.
NODES = 4_000
STEPS = 2_000_000
#: Bytes that the tables of the enumeration may take.
TABLE_BYTES = 64 << 20

Filling = tuple[int, ...]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- tokens ---------------------------------------------------------------------------------------

class Parts:
    """Parts of words that are remembered, by their number, and the ids of all of them in one array.

    Beyond ``CACHED_PARTS`` those go that fewest batches looked up, down to half as many or less.
    """

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, "<u4")
        self.starts = np.zeros(1, np.int64)
        self.batches = np.zeros(0, np.uint8)

    def add(self, parts: list[str], encoded: list[list[int]]) -> None:
        ids = np.fromiter(itertools.chain.from_iterable(encoded), "<u4")
        ends = self.starts[-1] + np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))
        self.ids, self.starts = np.append(self.ids, ids), np.append(self.starts, ends)
        self.batches = np.append(self.batches, np.zeros(len(parts), np.uint8))
        self.number.update(zip(parts, range(len(self.number), len(self.batches)), strict=True))

    def look_up(self, parts: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        self.batches[at] = np.minimum(self.batches[at], 254) + 1
        return at

    def forget(self) -> None:
        kept = (np.flatnonzero(self.batches >= least) for least in range(2, 257))
        kept = next(k for k in kept if 2 * len(k) <= CACHED_PARTS)
        length = np.diff(self.starts)[kept]
        names = list(self.number)
        self.number = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.ids = self.ids[_places(self.starts[kept], length)]
        self.starts, self.batches = np.append(0, np.cumsum(length)), np.ones(len(kept), np.uint8)


#: Of each tokenizer what a worker remembers.
_PARTS: dict[str, Parts] = {}


class WordIds:
    """Token ids of texts, as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text is the sequence of its
    space-separated words.  Arrow takes a batch apart, numbers its distinct words and takes last signs off
    them; the ids of parts seen before are remembered.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = _PARTS.setdefault(path, Parts())

    def __call__(self, texts: pa.Array | list[str]) -> Iterator[bytes]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(texts):
            return
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        rows = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        cores, signs = (part.dictionary_encode() for part in taken_apart(words.dictionary))
        ids, starts, length = self._ids(cores.dictionary.to_pylist() + signs.dictionary.to_pylist())
        # Every distinct word is a core and signs; every word of the texts is a distinct word.
        part = np.empty(2 * len(words.dictionary), np.int32)
        part[0::2] = cores.indices.to_numpy()
        part[1::2] = signs.indices.to_numpy() + len(cores.dictionary)
        ids = ids[_places(starts[part], length[part])]
        of_word = length[part].reshape(-1, 2).sum(axis=1)
        begins = np.cumsum(of_word) - of_word
        word = words.indices.to_numpy()
        length = of_word[word]
        out = ids[_places(begins[word], length)]
        ends = np.append(0, np.cumsum(length))[rows]
        for a, b in itertools.pairwise(ends.tolist()):
            yield out[a:b].tobytes()

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each part begin among them and how many they are."""
        known = self.known
        if len(known.number) > CACHED_PARTS:
            known.forget()
        missing = [p for p in dict.fromkeys(parts) if p not in known.number]
        if missing:
            known.add(missing, [e.ids for e in self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)])
        at = known.look_up(parts)
        return known.ids, known.starts[at], known.starts[at + 1] - known.starts[at]


def _places(starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Where the ids of all parts stand, one part after the other."""
    ends = np.cumsum(length, dtype=np.int64)
    at = np.repeat(starts - (ends - length), length)
    at += np.arange(len(at))
    return at


def taken_apart(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words as cores and the signs after them, in the lower case of ASCII, so that the ids are those of the two parts.

    The tokenizer lowers case itself and splits letters and digits from ASCII signs.
    """
    plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "|")))
    words = pc.if_else(plain, pc.ascii_lower(words), words)
    cores = pc.utf8_rtrim(words, characters=SIGNS)
    apart = pc.match_substring_regex(cores, "[0-9A-Za-z]$").to_numpy(zero_copy_only=False).copy()
    other = np.flatnonzero(pc.not_equal(cores, words).to_numpy(zero_copy_only=False) & ~apart)
    apart[other] = [not core or ends_word(core) for core in cores.take(pa.array(other)).to_pylist()]
    mask = pa.array(apart)
    signs = pc.struct_field(pc.extract_regex(words, f"(?P<signs>[{SIGNS}]*)$"), "signs")
    return pc.if_else(mask, cores, words), pc.if_else(mask, signs, "")


def ends_word(core: str) -> bool:
    """Whether the tokenizer, once it has normalised ``core``, ends a part of the text there before any sign.

    A last letter that becomes a letter and a mark does not: the mark and the signs after it are one part.
    """
    last = core[-1]
    return last.isalnum() and unicodedata.normalize("NFC", last).lower()[-1].isalnum()


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its ids if asked for."""
    path = tokenizer or default_tokenizer()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(path)
        for batch in slices(batches, "text", TEXT_BYTES):
            of, number, start, length, crc, ids = [], [], [], [], [], []
            for row, encoded in enumerate(ids_of(batch.column("text").fill_null(""))):
                encoded += end
                for k, at in enumerate(range(0, len(encoded), 4 * capacity)):
                    part = encoded[at : at + 4 * capacity]
                    of.append(row)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [
                batch.column("doc_id").take(pa.array(of, pa.int64())),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


# --- bin completion -------------------------------------------------------------------------------


def _best_fit(left: np.ndarray, room: int) -> Filling:
    """The largest length that fits, again and again."""
    out: list[int] = []
    while room > 0:
        fits = np.flatnonzero(left[: room + 1])
        fits = fits[::-1][:64]
        size = next((int(s) for s in fits if left[s] > out.count(int(s))), 0)
        if not size:
            break
        out.append(size)
        room -= size
    return tuple(out)


class Budget:
    """Steps of enumeration that a search may still take, and the rooms whose tables are in memory.

    Tables of all rooms take ``TABLE_BYTES`` at most, or one room more.  The room used least lately loses its
    tables first and makes them anew when the search comes back to it; that is not counted as a step.
    """

    def __init__(self, steps: int) -> None:
        self.steps = steps
        self.tables: OrderedDict[_Room, int] = OrderedDict()
        self.bytes = 0

    def used(self, room: _Room, size: int) -> None:
        self.bytes += size - self.tables.pop(room, 0)
        self.tables[room] = size
        while self.bytes > TABLE_BYTES and len(self.tables) > 1:
            oldest, held = self.tables.popitem(last=False)
            oldest.clear()
            self.bytes -= held

    def done(self, room: _Room) -> None:
        self.bytes -= self.tables.pop(room, 0)
        room.clear()


def _bits(sizes: np.ndarray) -> int:
    out = np.zeros(int(sizes[-1]) + 1 if len(sizes) else 1, np.uint8)
    out[sizes] = 1
    return int.from_bytes(np.packbits(out, bitorder="little").tobytes(), "little")


def _spread(sums: int, by: int) -> int:
    """Bits of all sums + 0 to ``by``."""
    done = 0
    while done < by:
        more = min(done + 1, by - done)
        sums |= sums << more
        done += more
    return sums


class _Room:
    """The lengths that may stand in a room, and which fillings of it others dominate.

    Another filling dominates one if the items of the one fit, in groups, into items of the other.  That is
    so exactly if some length that is left over can take the place of some of the items (none, one
    that is shorter, or several) without going over the room.

    Its tables follow from ``left``, which must be the same whenever the room is used; they may go in between.
    """

    def __init__(self, left: np.ndarray, room: int, taken: int, budget: Budget) -> None:
        self.left, self.room, self.taken, self.budget = left, room, taken, budget
        self.counted = False
        self.clear()

    def clear(self) -> None:
        self.number: list[int] | None = None
        self.sizes: list[int] = []
        self.bits = 0
        self.reach: list[int] | None = None

    def load(self) -> _Room:
        """This room with the number of items of each length, and the lengths in descending order."""
        if self.number is None:
            number = self.left[: self.room + 1].copy()
            if self.taken <= self.room:
                number[self.taken] -= 1
            sizes = np.flatnonzero(number)
            self.bits = _bits(sizes)
            self.sizes, self.number = sizes[::-1].tolist(), number.tolist()
            self.budget.used(self, 16 * self.room + 48 * len(self.sizes) + 256)
        return self

    def unused(self, filling: Filling) -> int:
        out = self.load().bits
        for s in set(filling):
            if filling.count(s) >= self.number[s]:
                out &= ~(1 << s)
        return out

    @staticmethod
    def sums(one: int, many: int, size: int) -> tuple[int, int]:
        """Sums of one item, and of several, with one more item."""
        return one | 1 << size, many | (one | many) << size

    def replaceable(self, filling: Filling, one: int, many: int, waste: int) -> bool:
        """Whether a longer item can take the place of one or more; more and shorter items leave that as it is."""
        longer = _spread(many, waste) | (_spread(one << 1, waste - 1) if waste else 0)
        return bool(longer & self.unused(filling))

    def dominated(self, filling: Filling, waste: int) -> bool:
        one = many = 0
        for s in filling:
            one, many = self.sums(one, many, s)
        addable = self.unused(filling) & ((1 << (waste + 1)) - 1)
        return bool(addable) or self.replaceable(filling, one, many, waste)

    def short(self, target: int) -> Iterator[Filling]:
        """One item or two that sum to ``target``, the longer first."""
        if self.load().number[target]:
            yield (target,)
        for s in range(target - 1, (target - 1) // 2, -1):
            number = self.load().number
            if number[s] and number[target - s] > (2 * s == target):
                yield (s, target - s)

    def reachable(self) -> list[int]:
        """Sums of the lengths from each one on downwards."""
        if self.load().reach is None:
            full = (1 << (self.room + 1)) - 1
            reach = [1]
            for s in reversed(self.sizes):
                sums, n, k = reach[-1], min(self.number[s], self.room // s), 1
                while n > 0:
                    k = min(k, n)
                    sums |= sums << k * s & full
                    n, k = n - k, 2 * k
                reach.append(sums)
            if not self.counted:
                self.budget.steps -= len(reach)
                self.counted = True
            self.reach = reach[::-1]
            self.budget.used(self, self.budget.tables[self] + sum(map(sys.getsizeof, reach)) + 8 * len(reach))
        return self.reach

    def long(self, target: int, waste: int) -> Iterator[Filling]:
        """Fillings that sum to ``target`` and may be undominated, in descending order.

        All items of ``waste`` and less are in: one left out could be added.
        """
        budget, sizes = self.budget, self.load().sizes
        stop = sum(s > waste for s in sizes)
        tail = tuple(s for s in sizes[stop:] for _ in range(self.number[s]))
        del sizes

        def grow(at: int, rest: int, chosen: Filling, one: int, many: int) -> Iterator[Filling]:
            if rest == 0:
                yield chosen + tail
                return
            for j in range(at, stop):
                if budget.steps <= 0 or not self.reachable()[j] >> rest & 1:
                    return
                s = self.sizes[j]
                for k in range(min(self.number[s], rest // s), 0, -1):
                    if not self.reachable()[j + 1] >> (rest - k * s) & 1:
                        continue
                    budget.steps -= 1
                    more, now = chosen + (s,) * k, (one, many)
                    for _ in range(k):
                        now = self.sums(*now, s)
                    if not self.replaceable(more, *now, waste):
                        yield from grow(j + 1, rest - k * s, more, *now)

        # A sum of the tail's items is known to be reachable; the rest must be reached without them.
        yield from grow(0, target - sum(tail), (), 0, 0)


def _order(filling: Filling, room: int) -> tuple:
    """The order in which ``fillings`` lists: least waste, one or two items first, then the longest."""
    return room - sum(filling), len(filling) > 2, [-s for s in filling]


def fillings(left: np.ndarray, room: int, most_waste: int, budget: Budget, taken: int | None = None) -> Iterator[Filling]:
    """All undominated fillings of ``room`` that waste ``most_waste`` at most, least waste first.

    ``left`` counts the items of each length, one of length ``taken`` being gone already; it must be the same
    again whenever the next filling is asked for.  One item that fills the room dominates everything.
    The enumeration is lazy and stops early only where ``budget`` is used up.
    """
    if room <= 0:
        yield ()
        return
    if left[room] > (taken == room):
        yield (room,)
        return
    state = _Room(left, room, room + 1 if taken is None else taken, budget)
    try:
        if not state.load().sizes:
            if room <= most_waste:
                yield ()
            return
        small = 0
        for waste in range(min(room, most_waste) + 1):
            target = room - waste
            # What is as short as the waste has to be in.
            small += waste * state.load().number[waste]
            if small > target or budget.steps <= 0:
                return
            if waste and not state.reachable()[0] >> target & 1:
                continue
            for filling in state.short(target):
                if not state.dominated(filling, waste):
                    yield filling
            for filling in state.long(target, waste):
                if len(filling) > 2 and not state.dominated(filling, waste):
                    yield filling
    finally:
        budget.done(state)


def fewest(left: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, the largest of the bounds for each ``small``.

    Lengths over capacity - small stand alone, others over half the capacity stand in sequences of
    their own too, and those from ``small`` to a half need the room that these leave, or more.
    """
    sizes = np.arange(capacity + 1)
    number, tokens = np.append(0, np.cumsum(left)), np.append(0, np.cumsum(left * sizes))
    half = capacity // 2
    small = np.arange(half + 1)
    alone = number[-1] - number[capacity - small + 1]
    large = number[capacity - small + 1] - number[half + 1]
    free = large * capacity - (tokens[capacity - small + 1] - tokens[half + 1])
    need = tokens[half + 1] - tokens[small]
    return int((alone + large + np.maximum(0, -(-(need - free) // capacity))).max())


def complete_bins(
    counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS
) -> list[tuple[Filling, int]]:
    """(lengths in one sequence, number of such sequences), as few sequences as the search finds.

    Sequences with the same largest length are filled in the order in which ``fillings`` lists, each
    filling as often as the counts and the waste allow and then less often, so every packing of undominated
    fillings comes up once.  The search ends early only after ``nodes`` choices of a filling (the first way
    down goes on) or ``steps`` of enumeration.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        left[size] = n
    total = int((left * np.arange(capacity + 1)).sum())
    least = fewest(left, capacity)

    def times(filling: Filling) -> int:
        return min(int(left[s]) // filling.count(s) for s in set(filling))

    def use(filling: Filling, n: int) -> None:
        for s in filling:
            left[s] -= n

    def bins(path: list[tuple[Filling, int]]) -> int:
        return sum(n for _, n in path)

    # The incumbent: best fit all the way down.
    path: list[tuple[Filling, int]] = []
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        filling = (largest, *_best_fit(left, capacity - largest))
        left[largest] += 1
        n = times(filling)
        use(filling, n)
        path.append((filling, n))
    best, fewest_found = path, bins(path)
    for filling, n in path:
        use(filling, -n)
    path, waste, seen, dive, budget = [], 0, 0, True, Budget(steps)

    def spare() -> int:
        """Waste that is left; beating the best means this much at most, the last sequence may be part empty."""
        return (fewest_found - 1) * capacity - total - waste

    def options(before: Filling | None) -> Iterator[tuple[Filling, int]]:
        largest = int(np.flatnonzero(left)[-1])
        room = capacity - largest
        after = _order(before[1:], room) if before and before[0] == largest else None
        for fill in fillings(left, room, spare(), budget, largest):
            if after is not None and _order(fill, room) <= after:
                continue
            filling = (largest, *fill)
            lost, n = capacity - sum(filling), times(filling)
            if lost:
                n = min(n, spare() // lost)
            if n < 1:
                return
            yield filling, n
            if len(fill) == 1 and fill[0] == room or not room:
                return  # it dominates all others, and itself less often
            for fewer in range(n - 1, 0, -1):
                yield filling, fewer

    open_options: list[Iterator[tuple[Filling, int]]] = []
    down = True
    while fewest_found > least and budget.steps > 0 and (dive or seen < nodes):
        if down and not left.any():
            best, fewest_found = path[:], bins(path)
        elif down:
            open_options.append(options(path[-1][0] if path else None))
        option = next(open_options[-1], None) if left.any() else None
        if option is None:
            if left.any():
                open_options.pop()
            if not path:
                break
            filling, n = path.pop()
            use(filling, -n)
            waste -= n * (capacity - sum(filling))
            down = dive = False
            continue
        filling, n = option
        seen += 1
        use(filling, n)
        waste += n * (capacity - sum(filling))
        path.append((filling, n))
        down = True
    return best


# --- placing --------------------------------------------------------------------------------------


def _lookup(plan: list[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """One row per length in a filling: which ranks of that length go where."""
    size, start, each, base, offset = [], [], [], [], []
    used: dict[int, int] = {}
    sequence = 0
    for filling, n in plan:
        at = 0
        for s, group in itertools.groupby(sorted(filling, reverse=True)):
            k = len(list(group))
            size.append(s)
            start.append(used.get(s, 0))
            each.append(k)
            base.append(sequence)
            offset.append(at)
            used[s] = used.get(s, 0) + k * n
            at += k * s
        sequence += n
    table = {"size": size, "start": start, "each": each, "base": base, "offset": offset}
    arrays = {k: np.array(v, dtype=np.int64) for k, v in table.items()}
    order = np.lexsort((arrays["start"], arrays["size"]))
    return {k: v[order] for k, v in arrays.items()}


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a table with a column ``length`` (1 to ``capacity``)."""
    cut = saved(cut.withColumn("_p_row", F.monotonically_increasing_id()))
    cut = cut.withColumn("_p_chunk", F.pmod(F.xxhash64("_p_row"), F.lit(CHUNKS)).cast("int"))
    parts = cut.groupBy("length", "_p_chunk").agg(F.count(F.lit(1)).alias("_p_n"))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_p_n").alias("n")).collect()}
    table = cut.sparkSession.sparkContext.broadcast(_lookup(complete_bins(counts, capacity)))
    # Ranks among pieces of one length: where a chunk begins, and the place in the chunk.
    in_length = Window.partitionBy("length").orderBy("_p_chunk")
    begins = parts.select("length", "_p_chunk", (F.sum("_p_n").over(in_length) - F.col("_p_n")).alias("_p_begin"))
    in_chunk = Window.partitionBy("length", "_p_chunk").orderBy("_p_row")
    ranked = cut.join(begins, ["length", "_p_chunk"]).withColumn(
        "_p_rank", F.col("_p_begin") + F.row_number().over(in_chunk) - 1
    )
    kept = [f for f in cut.schema.fields if not f.name.startswith("_p_")]
    names = [f.name for f in kept]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        keys = (t["size"] << 44) + t["start"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_p_rank").to_numpy(zero_copy_only=False)
            row = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            past = rank - t["start"][row]
            sequence = t["base"][row] + past // t["each"][row]
            offset = t["offset"][row] + past % t["each"][row] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return ranked.select(*names, "_p_rank").mapInArrow(look_up, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece of every document, with its place in a sequence."""
    return place(pieces(docs, tokenizer, keep_ids=keep_ids))
