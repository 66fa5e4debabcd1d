"""Near-duplicate groups: SuperMinHash signatures, banding, verified links, connected components.

A text's set holds the hashes of its distinct runs of ``WORDS`` words (A-Z lowered); fewer words are
one run.  Texts with equal sets are one node.  SuperMinHash ranks every element in all slots by one
random permutation, so its signature varies less than independent minima, and stops as soon as no
slot can fall further.  ``BANDS`` bands of ``ROWS`` slots make buckets; at a similarity of 0.8 a pair shares no bucket
with a probability of 5e-8.

Links are looked for without listing a bucket's pairs:

1. Each node is compared with one leader only, of all members of its buckets the one whose
   buckets are fullest: in a group of edited copies that is the unedited text.
2. Buckets whose members are not all connected by then are looked at again.  Their nodes are compared across
   components where they share one of their rarest elements: sets with 80% in common must share one of the
   first few in any common order.  Elements that occur in one node only can be shared with nobody, which
   bounds the size of a node's partners and leaves out most of what is left.

Every candidate is verified on the full sets, and components are found by alternating star contraction.
No step has a cap, and hot buckets are only ever aggregated or joined.

Defined cases: a text without words (or null) has the empty set and is linked with nothing.  Equal rows are
linked; a null id takes part, its component's id is the smallest id that is not null, or null.  An empty
table gives an empty table.  Only doc_id and text are read; other columns pass through ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptally.llm.counters import SCHEMA, Counter, slot, summed
from shoptally.llm.storage import saved
from shoptally.llm.words import fold_table, mix, slices, text_bytes, word_hashes

WORDS = 4
SLOTS = 128
ROWS = 4
BANDS = SLOTS // ROWS
#: 100 * intersection >= PERCENT * union.
PERCENT = 80

_SALTS = (0xC2B2AE3D27D4EB4F, 0x9E3779B185EBCA87, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, element) of every text, ordered by row and element."""
    hashes, rows = word_hashes(data, offsets, fold_table())
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    runs = max(0, len(hashes) - words + 1)
    value = np.zeros(runs, np.uint64)
    for k in range(words):
        value += hashes[k : k + runs] * np.uint64(_SALTS[k % 4] + 2 * (k // 4))
    whole = rows[:runs] == rows[words - 1 : words - 1 + runs]
    value, where = mix(value[whole]), rows[:runs][whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        first = np.searchsorted(rows, short)
        small = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            has = counts[short] > k
            small[has] += hashes[first[has] + k] * np.uint64(_SALTS[k % 4] + 2 * (k // 4))
        value = np.concatenate([value, mix(small + counts[short].astype(np.uint64))])
        where = np.concatenate([where, short])
    order = np.argsort(value)
    order = order[np.argsort(where[order], kind="stable")]
    value, where = value[order], where[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (where[1:] != where[:-1])
    return where[new], value[new]


def superminhash(rows: np.ndarray, elements: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures of ``n`` sets as an array (n, slots); empty sets keep infinity.

    In step j each element of a set that is not finished draws the j-th place of its own
    permutation of the slots (Fisher-Yates, one swap a step) and offers j + u there.  A set is finished
    when all its slots are below the offers of the next step.
    """
    signature = np.full(n * slots, np.inf)
    permuted: np.ndarray | None = None
    for j in range(slots):
        if not len(rows):
            break
        draw = mix(elements + np.uint64((0x632BE59BD9B4E019 * (j + 1)) & (2**64 - 1)))
        rank = j + (draw >> np.uint64(32)).astype(np.float64) / 2**32
        swap = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if permuted is None:
            slot = swap
        else:
            line = np.arange(len(rows))
            slot = permuted[line, swap].astype(np.int64)
            permuted[line, swap] = permuted[line, j]
        np.minimum.at(signature, rows * slots + slot, rank)
        open_sets = signature.reshape(n, slots).max(axis=1) > j + 1
        go_on = open_sets[rows]
        if permuted is None and go_on.any():
            permuted = np.broadcast_to(np.arange(slots, dtype=np.uint8), (int(go_on.sum()), slots)).copy()
            permuted[np.arange(len(permuted)), swap[go_on]] = 0
        elif permuted is not None and not go_on.all():
            permuted = permuted[go_on]
        rows, elements = rows[go_on], elements[go_on]
    return signature.reshape(n, slots)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, (n, bands)."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), -1, ROWS)
    key = np.zeros(bits.shape[:2], np.uint64)
    for k in range(ROWS):
        key = mix(key + bits[:, :, k] * np.uint64(_SALTS[k % 4]))
    return key


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, tie (hash of the text), n (set size), a 128-bit name of the set, band keys."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = len(batch)
            rows, elements = shingles(*text_bytes(batch.column("text")))
            counts = np.bincount(rows, minlength=n)
            names = []
            for salt in _SALTS[:2]:
                total = np.append(np.uint64(0), np.cumsum(mix(elements ^ np.uint64(salt))))
                ends = np.cumsum(counts)
                names.append(pa.array((total[ends] - total[ends - counts]).view(np.int64)))
            keys = band_keys(superminhash(rows, elements, n)).view(np.int64)
            keep = counts > 0
            offsets = np.append(0, np.cumsum(keep * BANDS)).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[keep].ravel()))
            columns = [batch.column("doc_id"), batch.column("tie"), pa.array(counts.astype(np.int64)), *names, bands]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "n", "set_a", "set_b", "bands"])

    return docs.select("doc_id", _tie().alias("tie"), "text").mapInArrow(
        sign, f"doc_id {id_type}, tie long, n long, set_a long, set_b long, bands array<long>"
    )


def _tie() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) of nodes whose full sets are similar enough."""
    both = pairs.join(texts.select(F.col("node").alias("x"), F.col("text").alias("text")), "x")
    both = both.join(texts.select(F.col("node").alias("y"), F.col("text").alias("other")), "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = len(batch)
            rows, elements = shingles(*text_bytes(batch.column("text")))
            rows2, elements2 = shingles(*text_bytes(batch.column("other")))
            r, e = np.concatenate([rows, rows2]), np.concatenate([elements, elements2])
            order = np.argsort(e)
            order = order[np.argsort(r[order], kind="stable")]
            r, e = r[order], e[order]
            common = np.bincount(r[1:][(r[1:] == r[:-1]) & (e[1:] == e[:-1])], minlength=n)
            union = np.bincount(r, minlength=n) - common
            yield batch.select(["x", "y"]).filter(pa.array(100 * common >= PERCENT * union))

    return both.select("x", "y", "text", "other").mapInArrow(compare, "x long, y long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest node of the component, for nodes that have an edge (x, y)."""
    edges = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x > y").distinct()
    edges, before = saved(edges), None
    while True:
        # Each edge points down.  Large star: larger neighbours move to the smallest one around.
        around = edges.select(F.col("x").alias("u"), F.col("y").alias("v")).unionAll(
            edges.select(F.col("y").alias("u"), F.col("x").alias("v"))
        )
        least = saved(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = edges.select(F.col("y").alias("u"), F.col("x").alias("v")).join(least, "u")
        large = saved(large.select(F.col("v").alias("x"), F.col("m").alias("y")).distinct())
        # Small star: a node and its smaller neighbours move to the smallest of these.
        down = saved(large.groupBy("x").agg(F.min("y").alias("m")))
        small = large.join(down, "x")
        moved = small.where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        edges = saved(moved.unionAll(down.select("x", F.col("m").alias("y"))).distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    lowest = edges.select("y").distinct().select(F.col("y").alias("node"), F.col("y").alias("component"))
    return edges.select(F.col("x").alias("node"), F.col("y").alias("component")).unionAll(lowest)


def _leaders(members: DataFrame) -> DataFrame:
    """(x, y): each node with the fullest member of its buckets."""
    weight = members.groupBy("node").agg(F.sum("size").alias("w"))
    weighed = saved(members.join(saved(weight), "node"))
    best = weighed.groupBy("band", "key").agg(F.max(F.struct("w", (-F.col("node")).alias("m"))).alias("best"))
    chosen = weighed.join(saved(best), ["band", "key"]).groupBy("node").agg(F.max("best").alias("best"))
    return chosen.select(F.col("node").alias("x"), (-F.col("best.m")).alias("y")).where("x <> y")


def _open_members(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with their component."""
    label = members.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    label = saved(label)
    mixed = label.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return label.join(saved(mixed.where("lo <> hi").select("band", "key")), ["band", "key"])


def _cross_pairs(open_members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that may be linked, from members of open buckets.

    Sets with at least a common elements share one among the |x| - a + 1 that come first in any order of
    all elements, and a is at least 4/9 of |x| and the smallest set around.  The order is by how often an
    element occurs in the sets looked at (in a table of fixed size), so what comes first is rare.
    """
    sizes = saved(open_members.groupBy("band", "key").agg(F.min("n").alias("low")))
    nodes = open_members.join(sizes, ["band", "key"]).groupBy("node", "component", "n").agg(F.min("low").alias("low"))
    sets = saved(texts.join(saved(nodes), "node"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in slices(batches, "text"):
            counter.add(shingles(*text_bytes(batch.column("text")))[1])
        yield from counter.parts()

    sent = texts.sparkSession.sparkContext.broadcast(summed(sets.select("text").mapInArrow(count, SCHEMA)))

    def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, elements = shingles(*text_bytes(batch.column("text")))
            often = sent.value[slot(elements)]
            order = np.lexsort((elements, often, rows))
            n, low = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("n", "low"))
            shared = np.bincount(rows[often > 1], minlength=len(batch))
            # A partner has at least 80% of this size, whatever else is around.
            least = -(-PERCENT * (n + np.maximum(low, -(-PERCENT * n // 100))) // (100 + PERCENT))
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            early = place < (n - least + 1)[rows]
            first, place = order[early], place[early]
            # reach: the largest set that this one can be linked with, given what it can share at all.
            reach = (100 + PERCENT) * shared // PERCENT - n
            useful = (often[first] > 1) & (reach >= low)[rows[first]]
            first, place = first[useful], place[useful]
            row = pa.array(rows[first])
            columns = [pa.array(elements[first].view(np.int64))]
            columns += [batch.column(k).take(row) for k in ("node", "component", "n")]
            columns += [pa.array(reach[rows[first]]), pa.array(n[rows[first]] - place)]
            yield pa.RecordBatch.from_arrays(columns, names=["element", "node", "component", "n", "reach", "after"])

    # after: how many elements of its set stand at or after this one in the order.
    schema = "element long, node long, component long, n long, reach long, after long"
    rare = saved(sets.mapInArrow(first_ones, schema))
    mixed = rare.groupBy("element").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    rare = saved(rare.join(saved(mixed.where("lo <> hi").select("element")), "element"))
    x, y = rare.alias("x"), rare.alias("y")
    may = (
        (F.col("x.element") == F.col("y.element"))
        & (F.col("x.component") < F.col("y.component"))
        & (F.col("x.n") <= F.col("y.reach"))
        & (F.col("y.n") <= F.col("x.reach"))
        # From the first element that both have on, there must be enough of them left in either.
        & ((100 + PERCENT) * F.least("x.after", "y.after") >= PERCENT * (F.col("x.n") + F.col("y.n")))
    )
    return x.join(y, may).select(F.col("x.node").alias("x"), F.col("y.node").alias("y")).distinct()


def components(docs: DataFrame) -> DataFrame:
    """doc_id, tie, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    signed = saved(signatures(docs))
    filled = signed.where("n > 0")
    # One node per distinct set, named by a number that is fixed once the table is written.
    nodes = filled.groupBy("set_a", "set_b", "n").agg(
        F.min("doc_id").alias("first_id"),
        F.min(F.struct("doc_id", "tie")).alias("row"),
        F.first("bands").alias("bands"),
    )
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id()))
    bands = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    buckets = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = saved(bands.join(saved(buckets), ["band", "key"]))
    wanted = members.select("node").distinct().join(nodes.select("node", "row.*"), "node")
    wanted = wanted.withColumnsRenamed({"doc_id": "row_id", "tie": "row_tie"})
    found = docs.select("doc_id", "text", _tie().alias("tie")).join(
        saved(wanted), F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("tie") == F.col("row_tie"))
    )
    # Rows may be repeated with their id; one text per node is enough.
    texts = saved(found.groupBy("node").agg(F.first("text").alias("text")))
    edges = saved(_linked(_leaders(members), texts))
    parts = connected(edges)
    left = saved(_open_members(members, parts))
    if not left.isEmpty():
        more = saved(_linked(_cross_pairs(left, texts), texts))
        if not more.isEmpty():
            parts = connected(edges.unionAll(more))
    parts = nodes.select("node", "set_a", "set_b", "n", "first_id").join(parts, "node", "left")
    parts = saved(parts.withColumn("component", F.coalesce("component", "node")))
    lowest = parts.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = saved(parts.join(saved(lowest), "component").select("set_a", "set_b", "n", "component_id"))
    out = signed.join(named, ["set_a", "set_b", "n"], "left")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "tie",
        F.col("n").alias("n_shingles"),
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
    )


def report(docs: DataFrame) -> DataFrame:
    return components(docs.select("doc_id", "text")).drop("tie")


def keep_first(docs: DataFrame) -> DataFrame:
    """The input's rows without all but one of each component: the one with its smallest id.

    Rows without words are all kept.
    """
    found = components(docs.select("doc_id", "text"))
    rows = saved(
        found.groupBy("doc_id", "tie").agg(
            F.first("n_shingles").alias("n"), F.first("component_id").alias("component_id"), F.count(F.lit(1)).alias("k")
        )
    )
    own = rows.where((F.col("n") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = own.groupBy(F.col("doc_id").alias("_d_id")).agg(F.min("tie").alias("_d_tie"))
    kept = kept.unionAll(rows.where("n = 0").select("doc_id", "tie"))
    marked = docs.withColumn("_d_mark", _tie())
    out = marked.join(
        saved(kept), F.col("doc_id").eqNullSafe(F.col("_d_id")) & (F.col("_d_mark") == F.col("_d_tie")), "left_semi"
    )
    if not rows.where("k > 1 AND n > 0").isEmpty():
        # Rows with equal id and text: the first of them stays.
        same = Window.partitionBy("doc_id", "_d_mark").orderBy(F.lit(1))
        out = out.withColumn("_d_place", F.row_number().over(same)).where("_d_place = 1 OR NOT text RLIKE '[^\\x20\\x09-\\x0D]'")
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
