"""The trie of conversation prefixes, built by cutting sequences at half their depth (van Emde Boas order).

A conversation is a sequence of turns and a node of the trie a distinct sequence of first turns.  All sequences
are cut at half the depth of the deepest one.  The first half of every sequence that reaches the cut is named by a
hash of what it began with and of the turns in it, and the lower halves hang from these names; both
halves are cut again, all pieces of one size at once, down to single turns.  That takes one pass per halving, and no
task sees a whole conversation: turns are keyed by conversation and place.

Totals over subtrees are grafted upward along the same cuts.  The path from the root to a node falls into pieces
whose sizes are powers of two, by the binary digits of its depth.  What a node adds is noted at the
bottom of each of its pieces and summed there over all nodes; then notes on pieces of one size are handed to their two
halves, the upper one by its cut node, until each is on a single node.  One pass per halving again,
each over the nodes at multiples of the size.

Turns count by 128-bit hashes of role and text and prefixes by 128-bit names (odds of two different prefixes of
n meeting in one name: about n^2 / 2^129).

Defined cases: turns are ordered by their number, null first, and equal numbers by the hash of role and text; a
null role or text is empty; repeated rows are turns of their own.  Rows without a conversation id belong to no
conversation and are left out.  A conversation without turns is a member of the root alone.  An empty table gives
an empty table.  Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptally.llm.resampling import CRC_STEPS_SQL, crc32_sql
from shoptally.llm.storage import saved
from shoptally.operators.ordering import sorted_in_ranges

#: Conversations share the first turns of the one whose id is the last multiple of this.
FAMILY = 100
#: They share fewer first turns than this.
SHARED = 6
#: Ids that are equal without so many last bits are joined in one row.
CHUNK_BITS = 12
NO_IDS = hashlib.sha256(b"").hexdigest()

TURN = ("conv", "at", "t1", "t2", "tokens")
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def located(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, at, t1, t2, tokens, _o_range) and runs (conv, _o_range, shift, own).

    ``at`` is the place of a turn in its part of the conversation; a conversation may reach over several ranges,
    ``shift`` is what brings the places of one part up to those of the whole, and ``own`` its number of turns.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("spelt"),
        F.length(text).cast("long").alias("tokens"),
    )
    placed = sorted_in_ranges(rows, ["conv", F.col("turn").asc_nulls_first(), "spelt"])
    runs = placed.groupBy("conv", "_o_range").agg(F.count(F.lit(1)).alias("n"), F.min("_o_at").alias("first"))
    parts = Window.partitionBy("conv")
    before = F.sum("n").over(parts.orderBy("_o_range")) - F.col("n")
    shift = (before - F.col("first") + 1).alias("shift")
    half = lambda start: F.conv(F.substring("spelt", start, 16), 16, -10).cast("long")
    turns = placed.select(
        "conv", F.col("_o_at").alias("at"), half(1).alias("t1"), half(17).alias("t2"), "tokens", "_o_range"
    )
    return turns, saved(runs.select("conv", "_o_range", shift, F.sum("n").over(parts).alias("own")))


def sequences(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, length) and their turns (conv, at, t1, t2, tokens), as they are."""
    turns, runs = located(conversations)
    rows = turns.join(runs, ["conv", "_o_range"]).withColumn("at", F.col("at") + F.col("shift"))
    return runs.groupBy("conv").agg(F.max("own").alias("length")), rows.select(*TURN)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same where each conversation begins with the first turns of its family's first one instead of its own."""
    turns, runs = located(conversations)
    place = F.pmod(F.col("conv"), F.lit(FAMILY))
    lengths = runs.groupBy("conv").agg(F.max("own").alias("own"))
    heads = lengths.where(place == 0).select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    plan = lengths.select(
        "conv", "own", (F.col("conv") - place).alias("base"), (F.crc32(F.col("conv").cast("string")) % SHARED).alias("shared")
    ).join(heads, "base", "left")
    taken = F.least(F.col("shared"), F.coalesce("base_own", F.lit(0).cast("long")))
    plan = saved(plan.select("conv", "base", "shared", taken.alias("taken"), "own"))
    # A turn meets the part of its conversation that its range holds, so a long conversation is no hot key.
    moves = runs.drop("own").join(plan, "conv")
    whole = saved(turns.join(moves, ["conv", "_o_range"]).withColumn("at", F.col("at") + F.col("shift")))
    later = whole.where("at > shared").withColumn("at", F.col("at") - F.col("shared") + F.col("taken"))
    first = whole.where((place == 0) & (F.col("at") < SHARED)).select(F.col("conv").alias("base"), *TURN[1:])
    given = plan.select("conv", "base", "taken").join(first, "base").where("at <= taken")
    length = F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    return plan.select("conv", length.alias("length")), later.select(*TURN).unionByName(given.select(*TURN))


def names(convs: DataFrame, rows: DataFrame, levels: int) -> DataFrame:
    """(conv, at, n1, n2): the name of the first ``at`` turns of each conversation, 0 to its length."""
    # Turns of every half that is cut off first, at every size; only halves that a conversation fills count.
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))
    spread = rows.select("conv", (F.col("at") - 1).alias("j"), "t1", "t2", level.alias("level"))
    size = F.expr("shiftleft(1L, level)")
    spread = spread.where(F.col("j").bitwiseAND(size) == 0).select(
        "conv",
        "level",
        (F.col("j") - F.pmod("j", size)).alias("from"),
        F.xxhash64("t1", "t2", "j").alias("h1"),
        F.xxhash64("j", "t2", "t1").alias("h2"),
    )
    blocks = spread.groupBy("conv", "level", "from").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.count(F.lit(1)).alias("n")
    )
    blocks = saved(blocks.where(F.col("n") == size).drop("n"))
    zero = F.lit(0).cast("long")
    found = convs.select("conv", zero.alias("at"), zero.alias("n1"), zero.alias("n2"))
    for k in reversed(range(levels)):
        half = blocks.where(F.col("level") == k).select("conv", F.col("from").alias("at"), "h1", "h2")
        cut = F.struct(
            (F.col("at") + (1 << k)).alias("at"),
            F.xxhash64("n1", "n2", "h1", "h2").alias("n1"),
            F.xxhash64("h2", "n1", "h1", "n2").alias("n2"),
        )
        root = F.struct("at", "n1", "n2")
        both = F.when(F.col("h1").isNull(), F.array(root)).otherwise(F.array(root, cut))
        found = found.join(half, ["conv", "at"], "left").select("conv", F.explode(both).alias("p")).select("conv", "p.*")
    return found


def _powers(levels: int) -> Column:
    return F.array(*(F.lit(1 << k).cast("long") for k in range(levels)))


def _bottoms(depth: Column, levels: int) -> Column:
    """The places on a path where its pieces end: ``depth`` without its last binary digits, one after the other."""
    places = F.transform(_powers(levels), lambda s: depth - F.pmod(depth, s))
    return F.filter(F.array_distinct(places), lambda p: p > 0)


def totals(ends: DataFrame, cuts: DataFrame, levels: int, sums: list[str]) -> DataFrame:
    """(n1, n2, and the sums over each node's subtree).

    ``ends``: (n1, n2, depth) of the bottoms of each node's pieces, with what the node adds; ``cuts``:
    (n1, n2, size, up1, up2), the node that is ``size`` above, for all sizes below the last binary digit of the depth.
    """
    add = [F.sum(c).alias(c) for c in sums]
    last = F.col("depth").bitwiseAND(-F.col("depth"))
    noted = saved(ends.withColumn("size", last).groupBy("n1", "n2", "size").agg(*add))
    held = noted.where(F.col("size") == 1 << levels).drop("size")
    for k in reversed(range(levels)):
        half = cuts.where(F.col("size") == 1 << k).drop("size")
        own, upper = F.struct("n1", "n2"), F.struct(F.col("up1").alias("n1"), F.col("up2").alias("n2"))
        handed = held.join(half, ["n1", "n2"]).select(F.explode(F.array(own, upper)).alias("p"), *sums)
        here = noted.where(F.col("size") == 1 << k).select("n1", "n2", *sums)
        held = handed.select("p.*", *sums).unionByName(here).groupBy("n1", "n2").agg(*add)
    return held


def _hashed(rows: DataFrame) -> DataFrame:
    """(n1, n2, sha256) of the chunks of each name, joined by commas in their order.

    A hash runs over its text from the first byte to the last, so the chunks of one name pass through one task,
    one after the other and never all in memory; each is a row of 4,096 ids at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n1", "n2", "ids")]
            for n1, n2, ids in zip(*columns, strict=True):
                if now != (n1, n2):
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (n1, n2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) > 1 << CHUNK_BITS:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["n1", "n2", "sha256"])
                out = []
        if now is not None:
            out.append((*now, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["n1", "n2", "sha256"])

    ordered = rows.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "chunk").select("n1", "n2", "ids")
    return ordered.mapInArrow(run, "n1 long, n2 long, sha256 string")


def ended(convs: DataFrame, named: DataFrame) -> DataFrame:
    """(n1, n2, sha256) of the ids, ascending, of the conversations that end at each node."""
    last = named.join(convs.select("conv", F.col("length").alias("at")), ["conv", "at"])
    chunks = last.groupBy("n1", "n2", F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    return _hashed(chunks.withColumn("ids", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",")))


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv, at, t1, t2, tokens), of ``convs`` (conv, length)."""
    convs, rows = saved(convs), saved(rows)
    deepest = convs.agg(F.max("length")).first()[0]
    levels = max(1, int(deepest or 0).bit_length())
    named = saved(names(convs, rows, levels))
    nodes = named.groupBy("n1", "n2").agg(
        F.min("conv").alias("conv_id"), F.max("at").alias("depth"), F.count(F.lit(1)).alias("n_convs")
    )
    tokens = rows.select(F.col("conv").alias("conv_id"), F.col("at").alias("depth"), "tokens")
    nodes = saved(nodes.join(tokens, ["conv_id", "depth"], "left"))
    # Above each node: its parent, the cuts of its last piece, and the bottoms of the pieces before.
    depth, distance = F.col("depth"), F.col("depth") - F.col("at")
    last = depth.bitwiseAND(-depth)
    cut_at = F.transform(F.filter(_powers(levels), lambda s: s <= last), lambda s: depth - s)
    places = F.explode(F.array_union(cut_at, _bottoms(depth, levels)))
    above = nodes.where("depth > 0").select("n1", "n2", "depth", "conv_id", places.alias("at"))
    seen = named.select(F.col("conv").alias("conv_id"), "at", F.col("n1").alias("up1"), F.col("n2").alias("up2"))
    above = saved(above.join(seen, ["conv_id", "at"]).drop("conv_id"))
    parents = above.where(distance == 1).select("n1", "n2", "up1", "up2")
    children = parents.groupBy(F.col("up1").alias("n1"), F.col("up2").alias("n2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    none = F.lit(0).cast("long")
    nodes = nodes.join(children, ["n1", "n2"], "left").withColumn("n_children", F.coalesce("n_children", none))
    added = (F.col("n_convs") - 1) * F.coalesce("tokens", none)
    nodes = saved(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": added}))
    sums = ["n_leaves", "saved_tokens"]
    of_paths = above.where(F.array_contains(_bottoms(depth, levels), F.col("at")))
    ends = of_paths.join(nodes.select("n1", "n2", *sums), ["n1", "n2"]).select(
        F.col("up1").alias("n1"), F.col("up2").alias("n2"), F.col("at").alias("depth"), *sums
    )
    cuts = above.where((distance > 0) & (distance < last)).select("n1", "n2", distance.alias("size"), "up1", "up2")
    root = nodes.agg(*(F.sum(c).alias(c) for c in sums)).select(none.alias("n1"), none.alias("n2"), *sums)
    below = totals(ends, cuts, levels, sums).unionByName(root)
    parent = nodes.select(F.col("n1").alias("up1"), F.col("n2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop(*sums).join(below, ["n1", "n2"])
    out = out.join(parents.join(parent, ["up1", "up2"]).drop("up1", "up2"), ["n1", "n2"], "left")
    out = out.join(ended(convs, named), ["n1", "n2"], "left")
    out = out.withColumn("ends_sha256", F.coalesce("sha256", F.lit(NO_IDS)))
    return out.select(*(f.split()[0] for f in NODE.split(", ")))


def report(conversations: DataFrame) -> DataFrame:
    """The nodes of all rebuilt conversations."""
    return trie(*rebuilt(conversations.select("conv_id", "turn", "role", "text")))


def report_sql() -> str:
    """The same nodes in DuckDB SQL, where every node meets all nodes on its path."""
    spelt = "md5(CAST(length(role) AS VARCHAR) || ':' || role || text)"
    return f"""
WITH k AS ({CRC_STEPS_SQL}),
x AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, {spelt} AS spelt, length(text) AS tokens,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {spelt}) AS pos FROM x),
l AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits, count(*) AS own FROM o GROUP BY conv_id),
c AS (SELECT conv_id, own, conv_id - ((conv_id % {FAMILY}) + {FAMILY}) % {FAMILY} AS base,
        {crc32_sql("digits", "steps")} % {SHARED} AS shared FROM l, k),
r AS (SELECT c.conv_id, o.pos, spelt, tokens FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.shared
      UNION ALL
      SELECT c.conv_id, o.pos - c.shared + least(c.shared, coalesce(b.own, 0)), spelt, tokens
      FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.shared LEFT JOIN l b ON b.conv_id = c.base),
p AS (SELECT conv_id, pos, tokens, md5(string_agg(spelt, ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS name FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT name, min(conv_id) AS conv_id, max(pos) AS depth, count(*) AS n_convs, max(tokens) AS tokens FROM p GROUP BY name),
u AS (SELECT n.name, n.depth, p.name AS above, p.pos FROM n JOIN p ON p.conv_id = n.conv_id AND p.pos <= n.depth),
h AS (SELECT above AS name, count(*) AS n_children FROM u WHERE pos = depth - 1 GROUP BY above),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN h USING (name)),
s AS (SELECT above AS name, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
        sum((n_convs - 1) * tokens) AS saved_tokens FROM u JOIN v USING (name) GROUP BY above),
e AS (SELECT name, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM p
      JOIN (SELECT conv_id, max(pos) AS pos FROM p GROUP BY conv_id) USING (conv_id, pos) GROUP BY name)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, v.n_convs,
  CAST(v.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends, '{NO_IDS}') AS ends_sha256
FROM v JOIN s USING (name) LEFT JOIN e USING (name)
  LEFT JOIN (SELECT u.name, n.conv_id FROM u JOIN n ON n.name = u.above WHERE u.pos = u.depth - 1) q USING (name)"""
